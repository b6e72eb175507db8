"""Session features: counts, event-weighted lengths, decay, last session, daily trend."""

from __future__ import annotations

from pyspark.sql import DataFrame

from churn_engine.functions.exprs import with_exprs
from churn_engine.functions.timeexpr import floor_div
from churn_engine.operators.activity import aggregates
from churn_engine.operators.distinct_items import SESSION, item_activity
from churn_engine.operators.snapshots import Snapshots


def session_activity(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Per (userId, obs_date): distinct sessions (all, recent, historical), mean session length over
    events, decayed number of sessions and the length of the session of the last event.

    The length looks at the whole log unless ``asof_sessions`` is set.
    """
    return item_activity(events, snapshots, [SESSION])


def session_trend(events: DataFrame, snapshots: Snapshots, min_days: int = 3) -> DataFrame:
    """Slope and sample standard deviation of distinct sessions per active day, against the ordinal of
    the day; 0 below ``min_days`` days.

    A session counts for a day from its first event of that day on, so it is enough to keep that
    moment. A day whose events have no session id is an active day with 0 sessions. Both values come from running sums of whole
    numbers over a user's days, so no date looks at the days again; a day that a date cuts changes its part later.
    """
    first = (
        with_exprs(snapshots.up_to_last_date(events), {"day": floor_div("ts_ms")})
        .groupBy("userId", "sessionId", "day")
        .agg(*aggregates({"first_ms": "min(ts_ms)"}))
    )
    starts = (
        with_exprs(first, {"age": snapshots.age("first_ms")})
        .groupBy("userId", "day", "age")
        .agg(*aggregates({"sessions": "count(sessionId)"}))
        .repartition("userId")
    )
    # The steps of a day, earliest first: how many sessions it had before each, and the ordinal of the day.
    numbered = starts.selectExpr(
        "userId",
        "sessions",
        f"{snapshots.enters} AS idx",
        "CAST(dense_rank() OVER (PARTITION BY userId ORDER BY day) - 1 AS BIGINT) AS x",
        "coalesce(sum(sessions) OVER (PARTITION BY userId, day ORDER BY age DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0L) AS before",
        "IF(row_number() OVER (PARTITION BY userId, day ORDER BY age DESC) = 1, 1L, 0L) AS opens",
    )
    sums = {
        "n": "sum(opens)",
        "x1": "sum(opens * x)",
        "x2": "sum(opens * x * x)",
        "y1": "sum(sessions)",
        "xy": "sum(x * sessions)",
        "y2": "sum(sessions * (sessions + 2 * before))",
    }
    changes = numbered.groupBy("userId", "idx").agg(*aggregates(sums))
    slope = "(n * xy - x1 * y1) / CAST(n * x2 - x1 * x1 AS DOUBLE)"
    deviation = "sqrt((n * y2 - y1 * y1) / CAST(n * (n - 1) AS DOUBLE))"
    return snapshots.along(
        changes,
        {c: f"sum({c})" for c in sums},
        {"session_freq_trend": f"IF(n >= {min_days}, {slope}, 0D)", "session_consistency": f"IF(n >= {min_days}, {deviation}, 0D)"},
    ).drop("obs_ms")
