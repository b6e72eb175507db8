"""The three feature sets: one row per (userId, obs_date).

Each side computes what it can on its own, in its own stage; only ratios across sides come after the
joins. That keeps the generated code of every stage small enough to be compiled by the JVM.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from churn_engine.functions.exprs import fill_zero, smoothed_ratio, with_exprs
from churn_engine.operators import derived
from churn_engine.operators.activity import PAGE_HITS, activity
from churn_engine.operators.distinct_items import SESSION, item_activity
from churn_engine.operators.session_activity import session_trend
from churn_engine.operators.snapshots import Snapshots
from churn_engine.schema import CARRIED, FEATURES_V0, FEATURES_V1, FEATURES_V2, KEYS


def _per_pass(build: Callable[[DataFrame, Snapshots], DataFrame], events: DataFrame, snapshots: Snapshots) -> DataFrame:
    return reduce(DataFrame.unionByName, [build(events, one) for one in snapshots.passes()])


def _joined(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Each side has one row per user and date. Sides are partitioned by ``userId`` or by both keys; with
    ``spark.sql.requireAllClusterKeysForCoPartition`` off, as :func:`build_session` sets it, the former are not
    shuffled again. A later side does not repeat a column of an earlier one."""
    return reduce(lambda left, right: left.join(right, KEYS, "left"), others, base)


def _with_windows(df: DataFrame) -> DataFrame:
    """Names of the distinct counts; a window without any event has no count, not a count of 0."""
    return with_exprs(
        df,
        {
            "num_sessions": "coalesce(num_sessions, 0L)",
            "sessions_last_7_days": "IF(recent_events > 0, coalesce(sessions_recent, 0L), NULL)",
            "sessions_historical": "IF(historical_events > 0, coalesce(sessions_in_historical, 0L), NULL)",
            "unique_artists": "coalesce(artist_seen, 0L)",
            "artists_last_7_days": "IF(recent_events > 0, coalesce(artist_recent, 0L), NULL)",
            "artists_historical": "IF(historical_events > 0, coalesce(artist_historical, 0L), NULL)",
        },
    )


def _features_v0(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    own = with_exprs(
        derived.tenure(activity(events, snapshots)),
        {"level": "level_mode", "songs_per_day": smoothed_ratio("num_songs_played", "days_active")},
    )
    sides = [item_activity(events, snapshots, [SESSION, "artist"])]
    df = with_exprs(
        _with_windows(_joined(own, *sides)),
        {
            "avg_session_length_seconds": "avg_session_length",
            "sessions_per_day": smoothed_ratio("num_sessions", "days_active"),
        },
    ).select(*KEYS, *FEATURES_V0, *CARRIED)
    return fill_zero(df, FEATURES_V0)


def _features(
    events: DataFrame, snapshots: Snapshots, names: list[str], fill: bool, extra: Callable | None = None
) -> DataFrame:
    own = derived.tenure(activity(events, snapshots))
    own = derived.risk_score(derived.days_since(derived.song_rates(own, snapshots.recent_days)))
    mine = [n for n in names if n in own.columns]
    final = [n for n in mine if n not in PAGE_HITS]
    own = own.select(*KEYS, "recent_events", "historical_events", *mine, *CARRIED)
    if fill:  # nothing after the joins needs these as unknown
        own = fill_zero(own, final)
    sides = [item_activity(events, snapshots, [SESSION, "artist", "song"])]
    if extra is not None:
        sides.append(extra(events, snapshots))
    df = with_exprs(_with_windows(_joined(own, *sides)), {"unique_songs": "coalesce(song_seen, 0L)"})
    df = derived.recency_ratios(derived.depth_ratios(derived.page_ratios(df))).select(*KEYS, *names, *CARRIED)
    return fill_zero(df, [n for n in names if n not in final]) if fill else df


def _features_v1(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    return _features(events, snapshots, FEATURES_V1, fill=True)


def _features_v2(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    return _features(events, snapshots, FEATURES_V2, fill=True, extra=session_trend)


def unfilled_v2(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Features 1-65 of one pass with NULLs still in place."""
    return _features(events, snapshots, FEATURES_V2, fill=False, extra=session_trend)


def features_v0(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """The first, small feature set (level by mode)."""
    return _per_pass(_features_v0, events, snapshots)


def features_v1(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Features 1-42. ``events`` is the whole cleaned log: the cut at each date happens here."""
    return _per_pass(_features_v1, events, snapshots)


def features_v2(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Features 1-65. ``events`` is the whole cleaned log: the cut at each date happens here."""
    return _per_pass(_features_v2, events, snapshots)


FEATURE_SETS = {"v0": features_v0, "v1": features_v1, "v2": features_v2}
FEATURE_NAMES = {"v0": FEATURES_V0, "v1": FEATURES_V1, "v2": FEATURES_V2}
