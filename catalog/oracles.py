"""Independent DuckDB SQL for the registered queries, over the same tables.

Written from the definitions, the plain way: events are joined to the dates and everything is grouped
per user and date, with distinct counts and windows where the definition says so.
"""

from __future__ import annotations

GRID = "(VALUES (TIMESTAMP '2024-01-05'), (TIMESTAMP '2024-01-10'), (TIMESTAMP '2024-01-15'), (TIMESTAMP '2024-01-20')) g(obs_date)"
SCORING_GRID = "(VALUES (TIMESTAMP '2024-01-25')) g(obs_date)"

LOG = """
kept AS (
  SELECT * REPLACE (seen AS ts), CAST(json_extract(props, '$.k') AS INTEGER) AS k, epoch_us(seen) AS us
  FROM (
    SELECT *, CASE WHEN user_id % 10 = 9 AND ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-20'
                   THEN ts - INTERVAL 20 DAY ELSE ts END AS seen
    FROM events
  )
),
placed AS (
  SELECT *,
    CASE WHEN event_type = 'view' AND k >= 97 THEN '' ELSE CAST(user_id AS VARCHAR) END AS userId,
    user_id * 1000 + ((us // 1000000) // 18000) % 1000 AS sessionId
  FROM kept
),
log AS (
  SELECT userId, sessionId,
    row_number() OVER (PARTITION BY userId, sessionId ORDER BY us, event_id) - 1 AS itemInSession,
    us // 1000 AS ts,
    TIMESTAMP '2023-06-01 09:30:00' + to_days(CAST(user_id % 200 AS INTEGER)) AS registration,
    CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN k = 50 THEN NULL
         WHEN user_id % 4 = 0 THEN 'free'
         WHEN user_id % 4 = 1 THEN 'paid'
         WHEN (user_id % 4 = 2) = (kept_ts < TIMESTAMP '2024-01-12 08:00:00') THEN 'free'
         ELSE 'paid' END AS level,
    CASE event_type
      WHEN 'view' THEN CASE WHEN k < 25 THEN 'Thumbs Up' WHEN k < 50 THEN 'Add to Playlist'
                            WHEN k < 75 THEN 'Home' WHEN k < 90 THEN 'Roll Advert' ELSE 'Login' END
      WHEN 'error' THEN CASE WHEN k < 30 THEN 'Help' WHEN k < 45 THEN 'Error' WHEN k < 70 THEN 'Settings'
                             WHEN k < 85 THEN 'Thumbs Down' ELSE 'Logout' END
      WHEN 'signup' THEN CASE WHEN k < 25 THEN 'Add Friend' WHEN k < 40 THEN 'About' WHEN k < 55 THEN 'Downgrade'
                              WHEN k < 65 THEN 'Submit Downgrade' WHEN k < 80 THEN 'Upgrade'
                              WHEN k < 88 THEN 'Submit Upgrade' WHEN k < 97 THEN 'Cancel'
                              ELSE 'Cancellation Confirmation' END
      ELSE 'NextSong' END AS page,
    CASE WHEN event_type IN ('purchase', 'click') THEN 'artist_' || (k % 20) END AS artist,
    CASE WHEN event_type IN ('purchase', 'click') THEN 'song_' || k END AS song,
    CASE WHEN event_type IN ('purchase', 'click') THEN value END AS length
  FROM (SELECT *, ts AS kept_ts FROM placed)
)"""

CLEAN = (
    LOG
    + """,
clean AS (
  SELECT CAST(userId AS BIGINT) AS userId, sessionId, itemInSession,
    make_timestamp(ts * 1000) AS ts, ts AS ts_ms, registration,
    CASE gender WHEN 'F' THEN 0 WHEN 'M' THEN 1 END AS gender,
    CASE level WHEN 'free' THEN 0 WHEN 'paid' THEN 1 END AS level,
    page, artist, song, length,
    CASE WHEN page = 'NextSong' THEN 1 ELSE 0 END AS song_played,
    max(ts) OVER (PARTITION BY userId, sessionId) - min(ts) OVER (PARTITION BY userId, sessionId) AS session_ms
  FROM log WHERE userId <> ''
)"""
)


def snap(grid: str = GRID, cutoff: bool = True, asof_sessions: bool = False) -> str:
    """CTE chain up to the table of (event, obs_date)."""
    length = (
        "max(c.ts_ms) OVER (PARTITION BY c.userId, c.sessionId, g.obs_date)"
        " - min(c.ts_ms) OVER (PARTITION BY c.userId, c.sessionId, g.obs_date)"
        if asof_sessions
        else "c.session_ms"
    )
    on = "c.ts <= g.obs_date" if cutoff else "true"
    return (
        CLEAN
        + f""",
snap AS (
  SELECT c.* EXCLUDE (session_ms), {length} AS session_ms, g.obs_date, epoch_ms(g.obs_date) AS obs_ms,
    c.ts >= g.obs_date - INTERVAL 7 DAY AS recent,
    c.ts >= g.obs_date - INTERVAL 30 DAY AND c.ts < g.obs_date - INTERVAL 14 DAY AS old,
    floor((epoch_ms(g.obs_date) - c.ts_ms) / 86400000.0) AS days_ago
  FROM clean c JOIN {grid} ON {on}
)"""
    )


def r(value: str) -> str:
    """6 places, half up with slack (the rule of the registered queries)."""
    return f"floor(CAST({value} AS DOUBLE) * 1e6 + CAST(0.5001 AS DOUBLE)) / 1e6"


def _days(col: str) -> str:
    return f"floor((obs_ms - {col}) / 86400000.0)"


def _count(condition: str) -> str:
    return f"nullif(count(*) FILTER (WHERE {condition}), 0)"


PAGES = {
    "friends_added": "page = 'Add Friend'",
    "thumbs_up_count": "page = 'Thumbs Up'",
    "thumbs_down_count": "page = 'Thumbs Down'",
    "playlists_created": "page = 'Add to Playlist'",
    "help_visits": "page = 'Help'",
    "error_count": "page = 'Error'",
    "settings_visits": "page = 'Settings'",
    "cancel_page_visits": "page = 'Cancel'",
    "logout_count": "page = 'Logout'",
    "home_visits": "page = 'Home'",
    "about_visits": "page = 'About'",
    "ad_count": "page = 'Roll Advert'",
    "downgrade_attempts": "page IN ('Downgrade', 'Submit Downgrade')",
    "upgrade_attempts": "page IN ('Upgrade', 'Submit Upgrade')",
}
RECENT_PAGES = {
    "cancel_visits_recent": "recent AND page = 'Cancel'",
    "help_visits_recent": "recent AND page = 'Help'",
    "thumbs_down_recent": "recent AND page = 'Thumbs Down'",
}

BASE = f""",
base AS (
  SELECT userId, obs_date, any_value(obs_ms) AS obs_ms,
    arg_min(gender, ts_ms) FILTER (WHERE gender IS NOT NULL) AS gender,
    arg_min(registration, ts_ms) FILTER (WHERE registration IS NOT NULL) AS registration,
    arg_min(level, ts_ms) FILTER (WHERE level IS NOT NULL) AS level_first,
    arg_max(level, ts_ms) FILTER (WHERE level IS NOT NULL) AS level_current,
    CASE WHEN count(*) FILTER (WHERE level = 1) > count(*) FILTER (WHERE level = 0) THEN 1 ELSE 0 END AS level,
    count(DISTINCT sessionId) AS num_sessions,
    max(itemInSession) AS max_item_in_session,
    min(ts) AS ts_min, max(ts) AS ts_max, min(ts_ms) AS first_ms, max(ts_ms) AS last_ms,
    sum(session_ms) / (count(*) * 1e3) AS avg_session_length,
    sum(song_played) AS num_songs_played,
    count(DISTINCT artist) AS unique_artists, count(DISTINCT song) AS unique_songs,
    coalesce(sum(length), 0) AS total_length, avg(length) AS avg_song_length,
    sum(song_played) FILTER (WHERE recent) AS songs_last_7_days,
    CASE WHEN bool_or(recent) THEN count(DISTINCT sessionId) FILTER (WHERE recent) END AS sessions_last_7_days,
    CASE WHEN bool_or(recent) THEN count(DISTINCT artist) FILTER (WHERE recent) END AS artists_last_7_days,
    sum(session_ms) FILTER (WHERE recent) / (count(*) FILTER (WHERE recent) * 1e3) AS avg_session_length_recent,
    sum(song_played) FILTER (WHERE old) AS songs_historical,
    CASE WHEN bool_or(old) THEN count(DISTINCT sessionId) FILTER (WHERE old) END AS sessions_historical,
    CASE WHEN bool_or(old) THEN count(DISTINCT artist) FILTER (WHERE old) END AS artists_historical,
    {", ".join(f"{_count(c)} AS {n}" for n, c in {**PAGES, **RECENT_PAGES}.items())},
    count(*) AS total_page_views,
    max(ts_ms) FILTER (WHERE page = 'Cancel') AS last_cancel,
    max(ts_ms) FILTER (WHERE page = 'Help') AS last_help,
    max(ts_ms) FILTER (WHERE page IN ('Downgrade', 'Submit Downgrade')) AS last_downgrade,
    sum(song_played * exp(-days_ago / 7)) / (sum(exp(-days_ago / 7)) + 1) AS weighted_songs,
    arg_max(session_ms, ts_ms) / 1e3 AS last_session_length
  FROM snap GROUP BY userId, obs_date
),
firsts AS (
  SELECT userId, obs_date, ts_ms, level,
    first_value(level IGNORE NULLS) OVER (PARTITION BY userId, obs_date ORDER BY ts_ms
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS level_first
  FROM snap
),
changes AS (
  SELECT userId, obs_date, max(ts_ms) AS last_change FROM firsts
  WHERE coalesce(level <> level_first, true) GROUP BY userId, obs_date
),
starts AS (
  SELECT userId, obs_date, any_value(obs_ms) AS obs_ms, sessionId, min(ts_ms) AS first_ms
  FROM snap GROUP BY userId, obs_date, sessionId
),
decayed AS (
  SELECT userId, obs_date, sum(exp(-{_days("first_ms")} / 7)) AS weighted_sessions FROM starts GROUP BY userId, obs_date
),
daily AS (
  SELECT userId, obs_date, CAST(ts AS DATE) AS day, count(DISTINCT sessionId) AS n
  FROM snap GROUP BY userId, obs_date, CAST(ts AS DATE)
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY userId, obs_date ORDER BY day) - 1 AS x FROM daily
),
trend AS (
  SELECT userId, obs_date,
    CASE WHEN count(*) >= 3 THEN regr_slope(n, x) ELSE 0 END AS session_freq_trend,
    CASE WHEN count(*) >= 3 THEN stddev_samp(n) ELSE 0 END AS session_consistency
  FROM numbered GROUP BY userId, obs_date
),
d1 AS (
  SELECT *, {_days("first_ms")} AS days_active, {_days("epoch_ms(registration)")} AS membership_length,
    {_days("last_ms")} AS days_since_last_activity,
    {_days("last_cancel")} AS days_since_cancel_visit, {_days("last_help")} AS days_since_help_visit,
    {_days("last_downgrade")} AS days_since_downgrade_attempt,
    CAST(coalesce(level_first = 1 AND level_current = 0, false) AS INTEGER) AS downgraded,
    thumbs_up_count + playlists_created + friends_added AS positive_actions,
    help_visits + error_count + settings_visits AS problem_signals
  FROM base
),
d2 AS (
  SELECT *, CASE WHEN days_active + 1 <> 0 THEN num_songs_played / (days_active + 1) END AS songs_per_day_overall,
    songs_last_7_days / 7.0 AS songs_per_day_recent
  FROM d1
),
d3 AS (
  SELECT *, CASE WHEN songs_per_day_overall + 1 <> 0 THEN songs_per_day_recent / (songs_per_day_overall + 1) END AS activity_decline FROM d2
),
unfilled AS (
  SELECT d3.*, coalesce({_days("last_change")}, membership_length) AS days_on_current_level,
    weighted_sessions, session_freq_trend, session_consistency,
    num_songs_played / (num_sessions + 1) AS songs_per_session,
    unique_artists / (num_songs_played + 1) AS artist_diversity,
    CAST(coalesce(friends_added > 0, false) AS INTEGER) AS has_social_activity,
    thumbs_up_count / (thumbs_down_count + thumbs_up_count + 1) AS satisfaction_ratio,
    (positive_actions + thumbs_down_count + help_visits) / (num_songs_played + 1) AS engagement_rate,
    ad_count / (num_songs_played + 1) AS ads_per_song,
    total_page_views / (num_sessions + 1) AS actions_per_session,
    songs_last_7_days / (songs_historical + 1) AS recent_vs_historical_songs,
    sessions_last_7_days / (sessions_historical + 1) AS recent_vs_historical_sessions,
    artists_last_7_days / (artists_historical + 1) AS recent_vs_historical_artists,
    avg_session_length_recent / (avg_session_length + 1) AS session_length_decline,
    artists_last_7_days / (sessions_last_7_days + 1) AS artist_exploration_rate,
    CASE WHEN cancel_page_visits > 0 THEN 3 ELSE 0 END + CASE WHEN help_visits > 2 THEN 2 ELSE 0 END
      + downgraded * 3 + CASE WHEN days_since_last_activity > 3 THEN 1 ELSE 0 END
      + CASE WHEN activity_decline < 0.5 THEN 2 ELSE 0 END
      + CASE WHEN thumbs_down_recent > thumbs_down_count / 2 THEN 1 ELSE 0 END AS churn_risk_score,
    num_songs_played / (days_active + 1) AS songs_per_day,
    num_sessions / (days_active + 1) AS sessions_per_day,
    avg_session_length AS avg_session_length_seconds
  FROM d3 LEFT JOIN changes USING (userId, obs_date) LEFT JOIN decayed USING (userId, obs_date)
    LEFT JOIN trend USING (userId, obs_date)
)"""

INTS = {"gender", "level", "level_first", "level_current", "downgraded", "has_social_activity", "churn_risk_score"}
DOUBLES = {
    "avg_session_length",
    "avg_session_length_seconds",
    "avg_song_length",
    "songs_per_day",
    "sessions_per_day",
    "songs_per_day_overall",
    "songs_per_day_recent",
    "activity_decline",
    "songs_per_session",
    "artist_diversity",
    "satisfaction_ratio",
    "engagement_rate",
    "ads_per_song",
    "actions_per_session",
    "avg_session_length_recent",
    "recent_vs_historical_songs",
    "recent_vs_historical_sessions",
    "recent_vs_historical_artists",
    "session_length_decline",
    "artist_exploration_rate",
    "session_freq_trend",
    "session_consistency",
    "weighted_songs",
    "weighted_sessions",
    "last_session_length",
    "total_length",
}
TIMES = {"registration", "ts_min", "ts_max"}

V0 = "gender level num_sessions max_item_in_session avg_session_length_seconds num_songs_played unique_artists days_active membership_length days_since_last_activity songs_per_day sessions_per_day".split()
V1 = (
    "gender level_first level_current num_sessions avg_session_length num_songs_played unique_artists unique_songs avg_song_length"
    " days_active membership_length days_since_last_activity songs_last_7_days sessions_last_7_days songs_per_day_overall"
    " songs_per_day_recent activity_decline songs_per_session artist_diversity downgraded"
).split() + [
    *PAGES,
    *"total_page_views has_social_activity positive_actions satisfaction_ratio engagement_rate problem_signals ads_per_song actions_per_session".split(),
]
V2 = V1 + (
    "artists_last_7_days avg_session_length_recent songs_historical sessions_historical artists_historical"
    " recent_vs_historical_songs recent_vs_historical_sessions recent_vs_historical_artists session_length_decline"
    " artist_exploration_rate days_on_current_level cancel_visits_recent help_visits_recent thumbs_down_recent"
    " days_since_cancel_visit days_since_help_visit days_since_downgrade_attempt session_freq_trend session_consistency"
    " weighted_songs weighted_sessions last_session_length churn_risk_score"
).split()
CARRIED = ["registration", "ts_min", "ts_max", "total_length"]


def column(name: str, fill: bool = True, digits: bool = True) -> str:
    """One output column in its final type, 0-filled and rounded as asked."""
    if name in TIMES:
        return name
    kind = "INTEGER" if name in INTS else "DOUBLE" if name in DOUBLES else "BIGINT"
    value = f"coalesce({name}, 0)" if fill else name
    value = f"CAST({value} AS {kind})"
    return f"{r(value)} AS {name}" if kind == "DOUBLE" and digits else f"{value} AS {name}"


def columns(names: list[str], fill: bool = True, digits: bool = True) -> str:
    return ", ".join(["userId", "obs_date", *[column(n, fill, digits) for n in names]])


def feature_query(names: list[str], fill: bool = True, **options) -> str:
    return f"WITH {snap(**options)}{BASE} SELECT {columns(names, fill)} FROM unfilled"


CHURNED = f""",
churned AS (
  SELECT DISTINCT c.userId, g.obs_date FROM clean c JOIN {GRID}
    ON c.ts > g.obs_date AND c.ts <= g.obs_date + INTERVAL 10 DAY
  WHERE c.page = 'Cancellation Confirmation'
)"""
LABELS = (
    CHURNED
    + """,
labels AS (
  SELECT u.userId, u.obs_date, CAST(h.userId IS NOT NULL AS INTEGER) AS churned
  FROM (SELECT DISTINCT userId, obs_date FROM snap) u LEFT JOIN churned h USING (userId, obs_date)
)"""
)


def labelled(names: list[str], digits: bool = True) -> str:
    """CTE chain up to ``rows``: features and label per (userId, obs_date)."""
    return (
        f"{snap()}{BASE}{LABELS}, rows AS (SELECT {columns(names, digits=digits)}, churned"
        " FROM unfilled JOIN labels USING (userId, obs_date))"
    )


KEY = "CAST(userId AS VARCHAR) || '|' || strftime(obs_date, '%Y-%m-%d %H:%M:%S')"


def uniform(md5: str, position: int = 0) -> str:
    return f"CAST(('0x' || substr({md5}, {1 + 13 * position}, 13)) AS BIGINT) / 4503599627370496.0"


RULES = (
    labelled(V2, digits=False)
    + """,
scored AS (
  SELECT 'risk_rule' AS model, 0 AS seq, userId, obs_date, churned AS label, churn_risk_score / 12.0 AS score FROM rows
  UNION ALL
  SELECT 'inactivity', 1, userId, obs_date, churned, least(days_since_last_activity, 30) / 30.0 FROM rows
  UNION ALL
  SELECT 'help_share', 2, userId, obs_date, churned, help_visits / (total_page_views + 1.0) FROM rows
),
predicted AS (
  SELECT *, CAST(score > CASE model WHEN 'risk_rule' THEN 0.47 WHEN 'inactivity' THEN 0.12 ELSE 0.015 END AS INTEGER) AS prediction
  FROM (SELECT * REPLACE (CAST(score AS DOUBLE) AS score) FROM scored)
),
cells AS (
  SELECT model, any_value(seq) AS seq,
    count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn, count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
    count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp
  FROM predicted GROUP BY model
),
per_class AS (
  SELECT model, '1' AS class, coalesce(tp / nullif(tp + fp, 0), 0) AS precision, coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
    coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1, tp + fn AS support FROM cells
  UNION ALL
  SELECT model, '0', coalesce(tn / nullif(tn + fn, 0), 0), coalesce(tn / nullif(tn + fp, 0), 0),
    coalesce(2 * tn / nullif(2 * tn + fp + fn, 0), 0), tn + fp FROM cells
),
weighted AS (
  SELECT model, sum(precision * support) / sum(support) AS precision, sum(recall * support) / sum(support) AS recall,
    sum(f1 * support) / sum(support) AS f1, CAST(sum(support) AS BIGINT) AS support FROM per_class GROUP BY model
),
accuracies AS (SELECT model, seq, (tn + tp) / (tn + fp + fn + tp) AS accuracy, tn + fp + fn + tp AS support FROM cells),
by_score AS (
  SELECT model, score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
  FROM predicted GROUP BY model, score
),
cumulative AS (
  SELECT model, score, sum(pos) OVER (PARTITION BY model ORDER BY score DESC) AS tp,
    sum(neg) OVER (PARTITION BY model ORDER BY score DESC) AS fp,
    sum(pos) OVER (PARTITION BY model) AS p, sum(neg) OVER (PARTITION BY model) AS n FROM by_score
),
points AS (
  SELECT model, score AS threshold, fp / n AS fpr, tp / p AS tpr FROM cumulative
  UNION ALL SELECT DISTINCT model, CAST('inf' AS DOUBLE), 0, 0 FROM by_score
),
area AS (
  SELECT model, sum((fpr - before_fpr) * (tpr + before_tpr) / 2) AS auc FROM (
    SELECT model, fpr, tpr, lag(fpr, 1, 0) OVER w AS before_fpr, lag(tpr, 1, 0) OVER w AS before_tpr
    FROM points WINDOW w AS (PARTITION BY model ORDER BY threshold DESC)
  ) GROUP BY model
)"""
)



def r_as(name: str) -> str:
    return f"{r(name)} AS {name}"


MINORITY = (
    labelled(V2)
    + f""",
points AS (
  SELECT {KEY} AS id, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in V2)} FROM rows WHERE churned = 1
),
pairs AS (
  SELECT a.id, b.id AS neighbour, {" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in V2)} AS d2
  FROM points a JOIN points b ON a.id <> b.id
),
ranked AS (
  SELECT id, neighbour, CAST(row_number() OVER (PARTITION BY id ORDER BY d2, neighbour) AS INTEGER) AS rank, sqrt(d2) AS distance
  FROM pairs
),
near AS (SELECT * FROM ranked WHERE rank <= 5)"""
)
SYNTHETIC = (
    MINORITY
    + f""",
sizes AS (SELECT count(*) FILTER (WHERE churned = 1) AS p, count(*) FILTER (WHERE churned = 0) AS n FROM rows),
numbered_points AS (SELECT *, row_number() OVER (ORDER BY md5(id || '|42')) AS idx FROM points),
draws AS (
  SELECT s, md5(CAST(s AS VARCHAR) || '|42') AS h, md5(CAST(s AS VARCHAR) || '|42|gap') AS g, p FROM sizes, range(0, n - p) r(s)
),
plan AS (
  SELECT s, CAST(floor({uniform("h", 0)} * p) AS BIGINT) + 1 AS idx,
    CAST(floor({uniform("h", 1)} * 5) AS INTEGER) + 1 AS rank, {uniform("g")} AS gap
  FROM draws
),
made AS (
  SELECT s, gap, b.id AS base, o.id AS neighbour, {", ".join(f"b.{c} + gap * (o.{c} - b.{c}) AS {c}" for c in V2)}
  FROM plan JOIN numbered_points b USING (idx) JOIN near k ON k.id = b.id AND k.rank = plan.rank JOIN points o ON o.id = k.neighbour
)"""
)


PROFILED = "userId sessionId itemInSession ts registration gender level page artist song length song_played".split()
NUMBERS = set("userId sessionId itemInSession gender level length song_played".split())
CATEGORIES = "page gender level artist song registration userId".split()


def _profile_of(name: str) -> str:
    mean = r(f"avg({name})") if name in NUMBERS else "CAST(NULL AS DOUBLE)"
    return (
        f"SELECT '{name}' AS \"column\", count(*) AS n_rows, count(*) - count({name}) AS nulls, CAST(min({name}) AS VARCHAR) AS least,"
        f" CAST(max({name}) AS VARCHAR) AS greatest, {mean} AS mean FROM clean"
    )


VALUES = (
    CLEAN
    + f""",
cells AS ({" UNION ALL ".join(f"SELECT '{c}' AS col, CAST({c} AS VARCHAR) AS value FROM clean" for c in CATEGORIES)}),
counted AS (SELECT col, value, count(*) AS n FROM cells WHERE value IS NOT NULL GROUP BY col, value)"""
)
CORRELATED = ["churned", *V2]


def _correlations(pairs: list[tuple[str, str]]) -> str:
    listed = ", ".join(f"struct_pack(a := '{a}', b := '{b}', n := count(*), c := corr({a}, {b}))" for a, b in pairs)
    return f"WITH {labelled(V2)}, packed AS (SELECT unnest([{listed}]) AS p FROM rows)"


def _round_all(names: list[str]) -> str:
    return ", ".join(r_as(c) for c in names)


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {
        "raw_log": f"WITH {LOG} SELECT * FROM log",
        "clean_events": f"WITH {CLEAN} SELECT * EXCLUDE (session_ms, ts_ms) FROM clean",
        "session_length": f"WITH {CLEAN} SELECT userId, sessionId, ts, {r('session_ms / 1e3')} AS session_length FROM clean",
        "snapshot_fanout": f"WITH {snap()} SELECT userId, sessionId, ts, page, obs_date FROM snap",
        "column_profile": f"WITH {CLEAN} {' UNION ALL '.join(map(_profile_of, PROFILED))}",
        "top_values": f"""WITH {VALUES}, ranked AS (
            SELECT *, row_number() OVER (PARTITION BY col ORDER BY n DESC, value) AS rank, sum(n) OVER (PARTITION BY col) AS total FROM counted)
          SELECT col AS "column", CAST(rank AS INTEGER) AS rank, value, n, {r('n / total')} AS share FROM ranked WHERE rank <= 10""",
        "category_profile": f"""WITH {VALUES}, drawn AS (
            SELECT *, row_number() OVER (PARTITION BY col ORDER BY md5(value), value) AS place FROM counted)
          SELECT col AS "column", count(*) AS values, CAST(sum(n) AS BIGINT) AS n,
            string_agg(value, '|' ORDER BY value) FILTER (WHERE place <= 5) AS samples FROM drawn GROUP BY col""",
        "correlation_matrix": f"""{_correlations([(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]])}
          SELECT p.a AS a, p.b AS b, p.n AS n, CASE WHEN isfinite(p.c) THEN {r('p.c')} END AS correlation FROM packed""",
        "label_correlation": f"""{_correlations([("churned", b) for b in V2])}
          SELECT p.b AS feature, p.n AS n, CASE WHEN isfinite(p.c) THEN {r('p.c')} END AS correlation FROM packed""",
        "churned_users": f"WITH {CLEAN} SELECT DISTINCT userId FROM clean WHERE page = 'Cancellation Confirmation'"
        " AND ts > TIMESTAMP '2024-01-10' AND ts <= TIMESTAMP '2024-01-20'",
        "churned_by_date": f"WITH {snap()}{CHURNED} SELECT * FROM churned",
        "labels": f"WITH {snap()}{LABELS} SELECT * FROM labels",
        "labels_without_churned": f"""WITH {snap()}{LABELS} SELECT * FROM labels l WHERE NOT EXISTS (
            SELECT 1 FROM clean c WHERE c.userId = l.userId AND c.page = 'Cancellation Confirmation' AND c.ts <= l.obs_date)""",
        "snapshot_report": f"WITH {snap()}{LABELS} SELECT obs_date, count(*) AS users, {r('avg(churned)')} AS churn_rate FROM labels GROUP BY obs_date",
        "user_base": feature_query(V1[:12]),
        "recent_activity": feature_query(
            ["songs_last_7_days", "sessions_last_7_days", "artists_last_7_days", "avg_session_length_recent"], fill=False
        ),
        "historical_activity": feature_query(["songs_historical", "sessions_historical", "artists_historical"], fill=False),
        "page_counts": feature_query(list(PAGES)[:12], fill=False),
        "up_downgrade_attempts": feature_query(["downgrade_attempts", "upgrade_attempts"], fill=False),
        "recent_page_counts": feature_query(list(RECENT_PAGES), fill=False),
        "days_since_events": feature_query(
            ["days_since_cancel_visit", "days_since_help_visit", "days_since_downgrade_attempt"], fill=False
        ),
        "level_change": feature_query(["level_first", "level_current", "downgraded", "days_on_current_level"], fill=False),
        "session_trend": feature_query(["session_freq_trend", "session_consistency"]),
        "decay_engagement": feature_query(["weighted_songs", "weighted_sessions"]),
        "last_session": feature_query(["last_session_length"]),
        "derived_ratios": feature_query(
            "songs_per_day_overall songs_per_day_recent activity_decline songs_per_session artist_diversity positive_actions"
            " satisfaction_ratio engagement_rate problem_signals ads_per_song actions_per_session recent_vs_historical_songs"
            " recent_vs_historical_sessions recent_vs_historical_artists session_length_decline artist_exploration_rate".split(),
            fill=False,
        ),
        "risk_score": feature_query(["churn_risk_score"]),
        "features_v0": feature_query(V0 + CARRIED),
        "features_v1": feature_query(V1 + CARRIED),
        "features_v2": feature_query(V2 + CARRIED),
        "features_v2_asof_sessions": feature_query(V2 + CARRIED, asof_sessions=True),
        "training_set_v1": f"WITH {labelled(V1)} SELECT * FROM rows",
        "training_set": f"WITH {labelled(V2)} SELECT * FROM rows",
        "scoring_set": feature_query(V2, grid=SCORING_GRID),
        "scoring_set_no_cutoff": feature_query(V2, grid=SCORING_GRID, cutoff=False),
        "class_weights": f"""WITH {snap()}{LABELS}, c AS (
            SELECT count(*) FILTER (WHERE churned = 0) AS negatives, count(*) FILTER (WHERE churned = 1) AS positives FROM labels)
          SELECT negatives, positives, {r('negatives / positives')} AS positive_weight,
            {r('(negatives + positives) / (2 * negatives)')} AS balanced_weight_0,
            {r('(negatives + positives) / (2 * positives)')} AS balanced_weight_1 FROM c""",
        "row_weights": f"""WITH {snap()}{LABELS}, c AS (
            SELECT count(*) AS n, count(*) FILTER (WHERE churned = 0) AS n0, count(*) FILTER (WHERE churned = 1) AS n1 FROM labels)
          SELECT userId, obs_date, churned, {r('CASE churned WHEN 1 THEN n / (2 * n1) ELSE n / (2 * n0) END')} AS balanced,
            {r('CASE churned WHEN 1 THEN n0 / n1 ELSE 1 END')} AS positive FROM labels, c""",
        "hash_split": f"""WITH {snap()}{LABELS} SELECT *, CAST({uniform(f"md5({KEY} || '|42')")} < 0.2 AS INTEGER) AS is_test FROM labels""",
        "stratified_folds": f"""WITH {snap()}{LABELS}
          SELECT *, CAST((row_number() OVER (PARTITION BY churned ORDER BY md5({KEY} || '|42')) - 1) % 5 AS INTEGER) AS fold FROM labels""",
        "plain_folds": f"""WITH {snap()}{LABELS}
          SELECT *, CAST((row_number() OVER (ORDER BY md5({KEY} || '|42')) - 1) % 3 AS INTEGER) AS fold FROM labels""",
        "user_folds": f"""WITH {snap()}{LABELS}
          SELECT *, CAST(floor({uniform("md5(CAST(userId AS VARCHAR) || '|42')")} * 5) AS INTEGER) AS fold FROM labels""",
        "scaled_features": f"""WITH {labelled(V2)}, split AS (SELECT *, {uniform(f"md5({KEY} || '|42')")} < 0.2 AS is_test FROM rows),
          moments AS (SELECT {", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in V2)} FROM split WHERE NOT is_test)
          SELECT userId, obs_date, {", ".join(f"{r(f'CASE WHEN s_{c} > 0 THEN (CAST({c} AS DOUBLE) - m_{c}) / s_{c} ELSE 0 END')} AS {c}" for c in V2)}
          FROM split, moments WHERE is_test""",
        "page_one_hot": f"""WITH {CLEAN}, pages AS (
            SELECT page, CAST(row_number() OVER (ORDER BY count(*) DESC, page) - 1 AS INTEGER) AS page_position FROM clean
            WHERE ts < TIMESTAMP '2024-01-03' GROUP BY page),
          levels AS (
            SELECT level, CAST(row_number() OVER (ORDER BY count(*) DESC, CAST(level AS VARCHAR)) - 1 AS INTEGER) AS level_position FROM clean
            WHERE ts < TIMESTAMP '2024-01-03' AND level IS NOT NULL GROUP BY level)
          SELECT userId, sessionId, itemInSession, c.page AS page, page_position, level_position,
            CAST(page_position IS NULL AS INTEGER) AS page_other, CAST(level_position IS NULL AND c.level IS NOT NULL AS INTEGER) AS level_other, 1 AS page_ones
          FROM clean c LEFT JOIN pages p ON c.page = p.page LEFT JOIN levels l ON c.level = l.level""",
        "smote_neighbours": f"WITH {MINORITY} SELECT id, neighbour, rank, {r('distance')} AS distance FROM near",
        "smote_resample": f"""WITH {SYNTHETIC}
          SELECT {KEY} AS id, {_round_all(V2)}, churned, 0 AS is_synthetic FROM rows
          UNION ALL SELECT 'synthetic|' || s, {_round_all(V2)}, 1, 1 FROM made""",
        "smote_resample_zero": f"""WITH {SYNTHETIC}
          SELECT {KEY} AS id, {_round_all(V2)}, 1 - churned AS churned, 0 AS is_synthetic FROM rows
          UNION ALL SELECT 'synthetic|' || s, {_round_all(V2)}, 0, 1 FROM made""",
        "confusion_matrix": f"""WITH {RULES}
          SELECT model, 0 AS label, 0 AS prediction, tn AS n FROM cells UNION ALL SELECT model, 0, 1, fp FROM cells
          UNION ALL SELECT model, 1, 0, fn FROM cells UNION ALL SELECT model, 1, 1, tp FROM cells""",
        "classification_report": f"""WITH {RULES}, report AS (
          SELECT * FROM per_class
          UNION ALL SELECT model, 'macro avg', avg(precision), avg(recall), avg(f1), CAST(sum(support) AS BIGINT) FROM per_class GROUP BY model
          UNION ALL SELECT model, 'weighted avg', precision, recall, f1, support FROM weighted
          UNION ALL SELECT model, 'accuracy', accuracy, accuracy, accuracy, support FROM accuracies)
          SELECT model, class, {r_as("precision")}, {r_as("recall")}, {r_as("f1")}, support FROM report""",
        "model_metrics": f"""WITH {RULES}
          SELECT w.model, {r_as("accuracy")}, {r('w.precision')} AS precision, {r('w.recall')} AS recall, {r('w.f1')} AS f1,
            {r('c.f1')} AS f1_positive
          FROM weighted w JOIN accuracies USING (model) JOIN per_class c ON c.model = w.model AND c.class = '1'""",
        "roc_curve": f"WITH {RULES} SELECT model, CASE WHEN isfinite(threshold) THEN {r('threshold')} END AS threshold, {r_as('fpr')}, {r_as('tpr')} FROM points",
        "roc_auc": f"WITH {RULES} SELECT model, {r_as('auc')} FROM area",
        "predicted_rate": f"WITH {RULES} SELECT model, count(*) AS rows, {r('avg(prediction)')} AS predicted_rate FROM predicted GROUP BY model",
        "threshold_score": f"WITH {RULES} SELECT model, userId, obs_date, {r('score')} AS score, prediction FROM predicted",
        "submission": f"WITH {RULES} SELECT userId AS id, prediction AS target FROM predicted WHERE model = 'risk_rule' AND obs_date = TIMESTAMP '2024-01-20'",
        "submission_renamed": f"WITH {RULES} SELECT userId, prediction FROM predicted WHERE model = 'risk_rule' AND obs_date = TIMESTAMP '2024-01-20'",
        "threshold_sweep": f"""WITH {RULES}, t AS (SELECT unnest([0.0001, 0.005, 0.015, 0.12, 0.45, 0.47, 0.5, 0.54])::DOUBLE AS threshold),
          k AS (SELECT model, threshold,
            count(*) FILTER (WHERE label = 0 AND score <= threshold) AS tn, count(*) FILTER (WHERE label = 0 AND score > threshold) AS fp,
            count(*) FILTER (WHERE label = 1 AND score <= threshold) AS fn, count(*) FILTER (WHERE label = 1 AND score > threshold) AS tp
            FROM predicted, t GROUP BY model, threshold)
          SELECT model, threshold, tn, fp, fn, tp, {r('(tp + fp) / (tn + fp + fn + tp)')} AS predicted_rate,
            {r('coalesce(tp / nullif(tp + fp, 0), 0)')} AS precision, {r('coalesce(tp / nullif(tp + fn, 0), 0)')} AS recall,
            {r('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0)')} AS f1 FROM k""",
        "model_comparison": f"""WITH {RULES}
          SELECT w.model, {r_as("accuracy")}, {r('w.precision')} AS precision, {r('w.recall')} AS recall, {r('w.f1')} AS f1,
            {r('c.f1')} AS f1_positive, a.seq, {r('auc')} AS auc,
            CAST(row_number() OVER (ORDER BY accuracy DESC, a.seq) = 1 AS INTEGER) AS is_best
          FROM weighted w JOIN accuracies a USING (model) JOIN per_class c ON c.model = w.model AND c.class = '1' JOIN area ON area.model = w.model""",
    }
    out["best_model"] = f"SELECT * EXCLUDE (is_best) FROM ({out['model_comparison']}) WHERE is_best = 1"
    return out
