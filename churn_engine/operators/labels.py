"""Who cancels, and when: labels per (userId, obs_date)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.functions.timeexpr import DAY_MS, millis_of, to_millis
from churn_engine.operators.snapshots import Snapshots, timestamp_literal
from churn_engine.schema import CHURN_PAGE, KEYS, LABEL


def cancellations(events: DataFrame) -> DataFrame:
    """Confirmed cancellations; the page filter reaches the scan."""
    return events.where(F.col("page") == CHURN_PAGE).select("userId", "ts_ms")


def churned_users(events: DataFrame, start: str | datetime, end: str | datetime) -> DataFrame:
    """Distinct users who cancel in (start, end]."""
    ms = F.col("ts_ms")
    return cancellations(events).where((ms > to_millis(start)) & (ms <= to_millis(end))).select("userId").distinct()


def churned_by_date(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Distinct (userId, obs_date) with a cancellation in (obs, obs + horizon].

    The range condition is resolved row by row against the short list of dates, so what remains for
    the join is an equality on user and date.
    """
    horizon = snapshots.horizon_days * DAY_MS
    grid = F.array(
        *[F.struct(timestamp_literal(d).alias("obs_date"), F.lit(to_millis(d)).alias("obs_ms")) for d in snapshots.dates]
    )
    ms = F.col("ts_ms")
    hits = F.filter(grid, lambda d: (ms > d["obs_ms"]) & (ms <= d["obs_ms"] + horizon))
    return cancellations(events).select("userId", F.inline(hits)).select(*KEYS).distinct()


def users_by_date(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Every (userId, obs_date) with an event up to the date: one row per user is fanned out."""
    users = snapshots.up_to_last_date(events).groupBy("userId").agg(F.min("ts_ms").alias("first_ms"))
    grid = F.array(
        *[F.struct(timestamp_literal(d).alias("obs_date"), F.lit(to_millis(d)).alias("obs_ms")) for d in snapshots.dates]
    )
    rows = users.select("userId", "first_ms", F.inline(grid))
    if snapshots.cutoff:
        rows = rows.where(F.col("first_ms") <= F.col("obs_ms"))
    return rows.select(*KEYS)


def with_label(rows: DataFrame, events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Add ``churned`` 0/1 to rows keyed by (userId, obs_date)."""
    churned = churned_by_date(events, snapshots).withColumn(LABEL, F.lit(1))
    return rows.join(churned, KEYS, "left").withColumn(LABEL, F.coalesce(F.col(LABEL), F.lit(0)))


def labels(events: DataFrame, snapshots: Snapshots, exclude_churned: bool = False) -> DataFrame:
    """(userId, obs_date, churned). Users who cancelled before the date stay in, labelled by what
    comes after it, unless ``exclude_churned``."""
    out = with_label(users_by_date(events, snapshots), events, snapshots)
    return without_churned(out, events) if exclude_churned else out


def without_churned(rows: DataFrame, events: DataFrame) -> DataFrame:
    """Leave out the rows of users who had cancelled by the date."""
    first = cancellations(events).groupBy("userId").agg(F.min("ts_ms").alias("_first_cancel"))
    joined = rows.join(first, "userId", "left")
    gone = F.coalesce(F.col("_first_cancel") <= F.expr(millis_of("obs_date")), F.lit(False))
    return joined.where(~gone).drop("_first_cancel")


def snapshot_report(labelled: DataFrame) -> DataFrame:
    """Users and churn rate per date."""
    return labelled.groupBy("obs_date").agg(
        F.count(F.lit(1)).alias("users"), F.avg(LABEL).alias("churn_rate")
    )
