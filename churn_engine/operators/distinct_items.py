"""Exact distinct counts per user, date and window, and what sessions add to them.

Sessions, artists and songs are items of a user and share one scan. Events are reduced to cells of one item and one 24-hour step; running
sums over an item's changes along the grid tell from which date to which it is seen, recent or historical, and only where that
changes is a row handed on to the user. Neither events nor items meet the dates one by one, so a grid may have any number of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from churn_engine.functions.exprs import with_exprs
from churn_engine.operators.activity import EVENT_ORDER, aggregates
from churn_engine.operators.snapshots import Snapshots

SESSION = "sessionId"
ITEM = "PARTITION BY userId, kind, item"


def distinct_items(events: DataFrame, snapshots: Snapshots, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values of ``columns`` per (userId, obs_date): ``<column>_seen``,
    ``<column>_recent`` and ``<column>_historical``."""
    return item_activity(events, snapshots, columns)


def item_activity(events: DataFrame, snapshots: Snapshots, columns: Sequence[str]) -> DataFrame:
    """Distinct values of ``columns``; where ``sessionId`` is one of them, also the session features.

    The first key spreads a single user's items, and a single item's events, over all tasks.
    """
    sessions = SESSION in columns
    if snapshots.asof_sessions or not sessions:
        events = snapshots.up_to_last_date(events)
    listed = ", ".join(f"CAST({c} AS STRING)" for c in columns)
    located = with_exprs(events, {"age": snapshots.age("ts_ms"), "on_mark": snapshots.on_mark("ts_ms"), "event_order": EVENT_ORDER})
    cell = {"n": "count(1)", "first_ms": "min(ts_ms)", "last_ms": "max(ts_ms)", "last": "max(event_order)"} if sessions else {"n": "count(1)"}
    cells = (
        located.selectExpr("userId", "age", "on_mark", "ts_ms", "event_order", f"posexplode(array({listed})) AS (kind, item)")
        .where("item IS NOT NULL")
        .groupBy("userId", "kind", "item", "age", "on_mark")
        .agg(*aggregates(cell))
        .repartition("userId", "kind", "item")
    )
    change = {"n": "sum(seen * n)", "recent": "sum(recent * n)", "historical": "sum(historical * n)"}
    if sessions:
        change |= {"first_ms": "min(first_ms)", "last_ms": "max(last_ms)", "seen_ms": "max(IF(seen = 1, last_ms, NULL))", "last": "max(IF(seen = 1, last, NULL))"}
    changes = cells.selectExpr("*", f"inline({snapshots.moves()})").groupBy("userId", "kind", "item", "idx").agg(*aggregates(change))
    # The state at a change and before it, from one sort of an item's changes.
    frames = {"": "CURRENT ROW", "old_": "1 PRECEDING"}
    running = {f"{old}{c}": f"sum({c}) OVER ({ITEM} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND {to})" for old, to in frames.items() for c in ("n", "recent", "historical")}
    kept = ["userId", "kind", "idx"]
    if sessions:
        whole = f"OVER ({ITEM} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
        running |= {"start_ms": f"min(first_ms) {whole}", "last": "last"}
        for old, to in frames.items():
            end = f"max(seen_ms) OVER ({ITEM} ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND {to})" if snapshots.asof_sessions else f"max(last_ms) {whole}"
            running[f"{old}end_ms"] = end
        kept += ["start_ms", "end_ms - start_ms AS span_ms", "last"]
    states = changes.selectExpr("userId", "kind", "idx", *[f"{x} AS {c}" for c, x in running.items()]).where(f"idx < {len(snapshots.dates)}")
    steps = {
        "is_seen": "IF(old_n IS NULL, 1L, 0L)",
        **{f"is_{w}": f"IF({w} > 0, 1L, 0L) - IF(coalesce(old_{w}, 0L) > 0, 1L, 0L)" for w in ("recent", "historical")},
    }
    if sessions:
        steps |= {
            "all_n": "n - coalesce(old_n, 0L)",
            "all_ms": "n * (end_ms - start_ms) - coalesce(old_n * (old_end_ms - start_ms), 0L)",
            "recent_n": "recent - coalesce(old_recent, 0L)",
            "recent_ms": "recent * (end_ms - start_ms) - coalesce(old_recent * (old_end_ms - start_ms), 0L)",
        }
    steps = states.selectExpr(*kept, *[f"{x} AS {c}" for c, x in steps.items()])
    sums = {
        f"{name}_{w}": f"sum(IF(kind = {kind}, is_{w}, 0L))" for kind, name in enumerate(columns) for w in ("seen", "recent", "historical")
    }
    ends: dict[str, str] = {}
    if sessions:
        at = columns.index(SESSION)
        mine = lambda x: f"IF(kind = {at}, {x}, NULL)"
        start = snapshots.weight(f"({snapshots.span} - {snapshots.age('start_ms')})")
        sums |= {c: f"sum({mine(c)})" for c in ("all_n", "all_ms", "recent_n", "recent_ms")}
        sums |= {"start_weight": f"sum(IF(kind = {at} AND is_seen = 1, {start}, 0D))"}
        ends = {"last_span": f"max_by(span_ms, {mine('last')})", "last": f"max({mine('last')})"}
    by_idx = steps.groupBy("userId", "idx").agg(*aggregates({**sums, **ends}))
    along = {c: f"sum({c})" for c in sums}
    final = {c: c for c in sums if c.rsplit("_", 1)[0] in columns and not c.startswith(SESSION)}
    if sessions:
        along |= {"last_span": "max_by(last_span, last)"}
        final |= {
            "num_sessions": f"nullif({SESSION}_seen, 0L)",
            "sessions_recent": f"{SESSION}_recent",
            "sessions_in_historical": f"{SESSION}_historical",
            # Whole milliseconds until the division: no summing order can change the result.
            "avg_session_length": "try_divide(all_ms, all_n * 1000D)",
            "avg_session_length_recent": "try_divide(recent_ms, recent_n * 1000D)",
            "weighted_sessions": f"IF({SESSION}_seen > 0, {snapshots.decayed('start_weight')}, NULL)",
            "last_session_length": "last_span / 1000D",
        }
    return snapshots.along(by_idx, along, final).drop("obs_ms")
