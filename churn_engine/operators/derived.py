"""Ratios, flags and the rule score computed from the aggregates of one row.

NULL means "nothing to measure" and goes through ``+`` and ``/``; 0 is filled in once, at the end.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from churn_engine.functions.exprs import flag, smoothed_ratio, with_exprs
from churn_engine.functions.timeexpr import days_between, millis_of


def tenure(df: DataFrame) -> DataFrame:
    """Days since first event, registration and last event."""
    return with_exprs(
        df,
        {
            "days_active": days_between("obs_ms", "first_ms"),
            "membership_length": days_between("obs_ms", millis_of("registration")),
            "days_since_last_activity": days_between("obs_ms", "last_ms"),
        },
    )


def song_rates(df: DataFrame, recent_days: int = 7) -> DataFrame:
    """Songs per day, their decline, and the downgrade flag."""
    df = with_exprs(
        df,
        {
            "songs_per_day_overall": smoothed_ratio("num_songs_played", "days_active"),
            "songs_per_day_recent": f"songs_last_7_days / {float(recent_days)}D",
            "recent_vs_historical_songs": smoothed_ratio("songs_last_7_days", "songs_historical"),
            "downgraded": flag("level_first = 1 AND level_current = 0"),
        },
    )
    return with_exprs(df, {"activity_decline": smoothed_ratio("songs_per_day_recent", "songs_per_day_overall")})


def page_ratios(df: DataFrame) -> DataFrame:
    """Satisfaction, engagement, problems and ads."""
    positive = "(thumbs_up_count + playlists_created + friends_added)"
    return with_exprs(
        df,
        {
            "has_social_activity": flag("friends_added > 0"),
            "positive_actions": positive,
            "satisfaction_ratio": smoothed_ratio("thumbs_up_count", "thumbs_down_count + thumbs_up_count"),
            "engagement_rate": smoothed_ratio(f"{positive} + thumbs_down_count + help_visits", "num_songs_played"),
            "problem_signals": "help_visits + error_count + settings_visits",
            "ads_per_song": smoothed_ratio("ad_count", "num_songs_played"),
        },
    )


def depth_ratios(df: DataFrame) -> DataFrame:
    """Songs and actions per session, and artists per song."""
    return with_exprs(
        df,
        {
            "songs_per_session": smoothed_ratio("num_songs_played", "num_sessions"),
            "artist_diversity": smoothed_ratio("unique_artists", "num_songs_played"),
            "actions_per_session": smoothed_ratio("total_page_views", "num_sessions"),
        },
    )


def recency_ratios(df: DataFrame) -> DataFrame:
    """Sessions and artists of the recent window against the historical one."""
    return with_exprs(
        df,
        {
            "recent_vs_historical_sessions": smoothed_ratio("sessions_last_7_days", "sessions_historical"),
            "recent_vs_historical_artists": smoothed_ratio("artists_last_7_days", "artists_historical"),
            "session_length_decline": smoothed_ratio("avg_session_length_recent", "avg_session_length"),
            "artist_exploration_rate": smoothed_ratio("artists_last_7_days", "sessions_last_7_days"),
        },
    )


def days_since(df: DataFrame) -> DataFrame:
    """Days since the last visit of critical pages and since the last event away from the first level
    (an unknown level counts as away); without one, the length of the membership."""
    other = "CASE level_first WHEN 0 THEN last_paid_ms WHEN 1 THEN last_free_ms END"
    changed = f"greatest(last_unknown_ms, {other})"
    return with_exprs(
        df,
        {
            "days_on_current_level": f"coalesce({days_between('obs_ms', changed)}, membership_length)",
            "days_since_cancel_visit": days_between("obs_ms", "last_cancel_ms"),
            "days_since_help_visit": days_between("obs_ms", "last_help_ms"),
            "days_since_downgrade_attempt": days_between("obs_ms", "last_downgrade_ms"),
        },
    )


@dataclass(frozen=True)
class RiskWeights:
    """Points per warning sign, and the bounds that raise it (fixed values of the rule)."""

    cancel_visit: int = 3
    many_help_visits: int = 2
    downgraded: int = 3
    inactive: int = 1
    declining: int = 2
    recent_thumbs_down: int = 1
    help_above: int = 2
    inactive_days_above: int = 3
    decline_below: float = 0.5

    @property
    def maximum(self) -> int:
        return (
            self.cancel_visit
            + self.many_help_visits
            + self.downgraded
            + self.inactive
            + self.declining
            + self.recent_thumbs_down
        )


def risk_score(df: DataFrame, weights: RiskWeights = RiskWeights()) -> DataFrame:
    """Weighted sum of warning signs, judged before NULLs are filled (an unknown value warns of
    nothing)."""
    w = weights
    signs = {
        "cancel_page_visits > 0": w.cancel_visit,
        f"help_visits > {w.help_above}": w.many_help_visits,
        "downgraded = 1": w.downgraded,
        f"days_since_last_activity > {w.inactive_days_above}": w.inactive,
        f"activity_decline < {float(w.decline_below)}D": w.declining,
        "thumbs_down_recent > thumbs_down_count / 2": w.recent_thumbs_down,
    }
    return with_exprs(df, {"churn_risk_score": " + ".join(f"{flag(sign)} * {n}" for sign, n in signs.items())})
