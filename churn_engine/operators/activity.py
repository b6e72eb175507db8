"""Per-user activity: page counts, songs, first/last values, recency.

Three steps. Events are reduced to cells of one user and one 24-hour step back from the last date
(partially on the map side, so a user with a third of the log is no hot spot). A window bound is always
a whole number of days from a date, so the cells carry everything any window of any date needs. Each cell, at most two per
user and day, becomes the few changes it makes along the grid: it is seen from one date on, and enters and leaves each window once. Running
sums over a user's changes give the values at every date, so a grid may have any number of dates.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.functions.exprs import with_exprs
from churn_engine.functions.timeexpr import timestamp_of
from churn_engine.operators.snapshots import Snapshots
from churn_engine.schema import PAGE_COUNTS, PAGE_SET_COUNTS

CELL = ["userId", "age", "on_mark"]

# Time order within a user as one number: milliseconds, then the position in the session. The factor is more
# than twice the span of a doubled BIGINT position, so nothing is cut off, and even, so a 0/1 code can be added.
EVENT_ORDER = "CAST(ts_ms AS DECIMAL(19, 0)) * 40000000000000000000BD + CAST(coalesce(itemInSession, 0L) AS DECIMAL(19, 0)) * 2BD"


def _page_is(pages: str | list[str]) -> str:
    listed = ", ".join(f"'{p}'" for p in ([pages] if isinstance(pages, str) else pages))
    return f"page IN ({listed})"


PAGE_HITS = {name: _page_is(pages) for name, pages in {**PAGE_COUNTS, **PAGE_SET_COUNTS}.items()}

# Mergeable aggregates of a cell, as SQL text. First and last value in time order: the order key is even
# and the 0/1 code is added to it, so a plain, hash-aggregated min / max finds it, and ties do not
# depend on the row order.
CELL_AGGREGATES = {
    "events": "count(1)",
    "songs": "sum(song_played)",
    "length_sum": "sum(length)",
    "length_count": "count(length)",
    "first_ms": "min(ts_ms)",
    "last_ms": "max(ts_ms)",
    "gender_key": "min(event_order + gender)",
    "level_first_key": "min(event_order + level)",
    "level_last_key": "max(event_order + level)",
    "registration": "min_by(registration, IF(registration IS NOT NULL, event_order, NULL))",
    "registration_order": "min(IF(registration IS NOT NULL, event_order, NULL))",
    "max_item": "max(itemInSession)",
    "free_events": "count_if(level = 0)",
    "paid_events": "count_if(level = 1)",
    "last_free_ms": "max(IF(level = 0, ts_ms, NULL))",
    "last_paid_ms": "max(IF(level = 1, ts_ms, NULL))",
    "last_unknown_ms": "max(IF(level IS NULL, ts_ms, NULL))",
    **{name: f"count_if({hit})" for name, hit in PAGE_HITS.items()},
    "last_cancel_ms": f"max(IF({PAGE_HITS['cancel_page_visits']}, ts_ms, NULL))",
    "last_help_ms": f"max(IF({PAGE_HITS['help_visits']}, ts_ms, NULL))",
    "last_downgrade_ms": f"max(IF({PAGE_HITS['downgrade_attempts']}, ts_ms, NULL))",
}


def aggregates(columns: dict[str, str]) -> list:
    """Aggregate columns from SQL text."""
    return [F.expr(f"{text} AS {name}") for name, text in columns.items()]


def activity_cells(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """One row per (userId, age, on_mark) with mergeable aggregates; callers use what they need and
    Catalyst drops the rest, down to the scanned columns."""
    located = with_exprs(
        events,
        {"age": snapshots.age("ts_ms"), "on_mark": snapshots.on_mark("ts_ms"), "event_order": EVENT_ORDER},
    )
    return located.groupBy(*CELL).agg(*aggregates(CELL_AGGREGATES))


def activity(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Aggregates per (userId, obs_date), plus ``obs_ms``; counts of pages never seen are NULL.

    The cells of a user are brought together once (two rows per day at most); changes and running sums
    then need no further exchange.
    """
    cells = activity_cells(snapshots.up_to_last_date(events), snapshots).repartition("userId")
    cells = with_exprs(cells, {"weight": snapshots.weight(f"{snapshots.span} - age")})
    seen = lambda column: f"IF(seen = 1, {column}, NULL)"
    sums = {
        "total_page_views": "sum(seen * events)",
        "recent_events": "sum(recent * events)",
        "historical_events": "sum(historical * events)",
        "num_songs_played": "sum(seen * songs)",
        "recent_songs": "sum(recent * songs)",
        "historical_songs": "sum(historical * songs)",
        "length_sum": f"sum({seen('length_sum')})",
        "length_count": "sum(seen * length_count)",
        "song_weight": "sum(seen * songs * weight)",
        "event_weight": "sum(seen * events * weight)",
        "free_events": "sum(seen * free_events)",
        "paid_events": "sum(seen * paid_events)",
        **{name: f"sum(seen * {name})" for name in PAGE_HITS},
        "cancel_visits_recent": "sum(recent * cancel_page_visits)",
        "help_visits_recent": "sum(recent * help_visits)",
        "thumbs_down_recent": "sum(recent * thumbs_down_count)",
    }
    ends = {
        "first_ms": "min(first_ms)",
        "last_ms": "max(last_ms)",
        "gender_key": "min(gender_key)",
        "level_first_key": "min(level_first_key)",
        "level_last_key": "max(level_last_key)",
        "max_item_in_session": "max(max_item)",
        **{f"last_{x}_ms": f"max(last_{x}_ms)" for x in ("free", "paid", "unknown", "cancel", "help", "downgrade")},
    }
    own = {column: f"{x[:4]}{seen(x[4:-1])})" for column, x in ends.items()}
    changes = (
        cells.selectExpr("*", f"inline({snapshots.moves()})")
        .groupBy("userId", "idx")
        .agg(
            *aggregates(
                {
                    **sums,
                    **own,
                    "registration": f"min_by(registration, {seen('registration_order')})",
                    "registration_order": f"min({seen('registration_order')})",
                }
            )
        )
    )
    running = {
        **{column: f"sum({column})" for column in sums},
        **{column: f"{x[:3]}({column})" for column, x in ends.items()},
        "registration": "min_by(registration, registration_order)",
    }
    unknown = {*PAGE_HITS, "cancel_visits_recent", "help_visits_recent", "thumbs_down_recent"}
    final = {column: f"nullif({column}, 0L)" if column in unknown else column for column in running}
    final |= {column: snapshots.decayed(column) for column in ("song_weight", "event_weight")}
    merged = snapshots.along(changes, running, final)
    return with_exprs(
        merged,
        {
            "gender": "CAST(pmod(gender_key, 2BD) AS INT)",
            "level_first": "CAST(pmod(level_first_key, 2BD) AS INT)",
            "level_current": "CAST(pmod(level_last_key, 2BD) AS INT)",
            "level_mode": "IF(paid_events > free_events, 1, 0)",
            "ts_min": timestamp_of("first_ms"),
            "ts_max": timestamp_of("last_ms"),
            "total_length": "coalesce(length_sum, 0D)",
            "avg_song_length": "IF(length_count > 0, length_sum / length_count, NULL)",
            "songs_last_7_days": "IF(recent_events > 0, recent_songs, NULL)",
            "songs_historical": "IF(historical_events > 0, historical_songs, NULL)",
            "weighted_songs": "song_weight / (event_weight + 1D)",
        },
    )
