"""As-of snapshots on a date grid."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.functions.timeexpr import DAY_MS, days_between, parse_date, timestamp_literal, timestamp_sql, to_millis

# Decayed sums hold exp(days / decay_days) for up to this quotient; far below the greatest exponent of a double.
MAX_DECAY_SPAN = 600


def date_grid(start: str | datetime, end: str | datetime, step_days: int = 5) -> list[datetime]:
    """start, start + step, ... up to and including end."""
    first, last = parse_date(start), parse_date(end)
    count = (last - first) // timedelta(days=step_days) + 1
    return [first + timedelta(days=step_days * i) for i in range(count)]


@dataclass(frozen=True)
class Snapshots:
    """The observation dates and the lengths of the windows around each of them.

    ``cutoff``: use only events up to the date (a test log may be used whole).
    ``asof_sessions``: measure a session only up to the date; otherwise its length comes from the
    whole log, also when it goes on after the date.
    """

    dates: Sequence[datetime]
    recent_days: int = 7
    historical_start_days: int = 30
    historical_end_days: int = 14
    decay_days: float = 7.0
    horizon_days: int = 10
    cutoff: bool = True
    asof_sessions: bool = False

    def __post_init__(self) -> None:
        object.__setattr__(self, "dates", tuple(sorted({parse_date(d) for d in self.dates})))
        if not self.dates:
            raise ValueError("at least one observation date is needed")

    @classmethod
    def every(cls, start: str | datetime, end: str | datetime, step_days: int = 5, **options) -> Snapshots:
        return cls(date_grid(start, end, step_days), **options)

    @classmethod
    def at(cls, day: str | datetime, **options) -> Snapshots:
        return cls([parse_date(day)], **options)

    def passes(self) -> Iterable[Snapshots]:
        """Sub-grids whose dates lie whole days apart.

        A regular grid is one pass, whatever its number of dates; only a grid of many years is cut, after
        ``MAX_DECAY_SPAN * decay_days`` days (11 years by default).
        """
        by_time: dict[int, list[datetime]] = {}
        for day in self.dates:
            by_time.setdefault(to_millis(day) % DAY_MS, []).append(day)
        longest = timedelta(days=int(MAX_DECAY_SPAN * self.decay_days))
        for days in by_time.values():
            start = 0
            for i in range(1, len(days) + 1):
                if i == len(days) or days[i] - days[start] > longest:
                    yield replace(self, dates=days[start:i])
                    start = i

    @property
    def anchor_ms(self) -> int:
        return to_millis(self.dates[-1])

    # --- SQL text: position of an event relative to the last date, and the windows -----------------

    def age(self, ms: str) -> str:
        """Whole days from the event to the last date of the pass (rounded down)."""
        return days_between(f"{self.anchor_ms}L", ms)

    def on_mark(self, ms: str) -> str:
        """Whether the event lies a whole number of days from the dates, i.e. on a window bound."""
        return f"pmod({self.anchor_ms}L - {ms}, {DAY_MS}L) = 0"

    # --- a cell on the grid -------------------------------------------------------------------------
    #
    # A cell is (age, on_mark). With o the days from the first date, it is seen from the first date with o >= step on, where
    # step = span - age; and since window bounds are whole days, it enters or leaves a window of n days at the first date with
    # o >= step + n, or one more if it lies on the mark.

    @property
    def offsets(self) -> list[int]:
        """Days from the first date to each date."""
        return [(to_millis(d) - to_millis(self.dates[0])) // DAY_MS for d in self.dates]

    @property
    def span(self) -> int:
        return self.offsets[-1]

    def first_index(self, offset: str) -> str:
        """SQL text: index of the first date that is at least ``offset`` days after the first one; the number of dates if there is none."""
        n, offsets = len(self.dates), self.offsets
        if n == 1:
            return f"IF({offset} <= 0, 0, 1)"
        step = offsets[1]
        if offsets == [step * i for i in range(n)]:
            return f"CAST(least(greatest(ceil(({offset}) / {float(step)}D), 0L), {n}L) AS INT)"
        index, at = [], 0
        for o in range(self.span + 1):
            at += offsets[at] < o
            index.append(str(at))
        return f"IF({offset} <= 0, 0, IF({offset} > {self.span}, {n}, element_at(array({', '.join(index)}), CAST({offset} AS INT) + 1)))"

    @property
    def enters(self) -> str:
        """Index of the first date that sees a cell."""
        return self.first_index(f"({self.span} - age)") if self.cutoff else "0"

    def moves(self) -> str:
        """SQL text of an array of ``(idx, seen, recent, historical)``: how a cell's membership changes along the grid.

        A cell after the last date has one entry beyond the grid.
        """
        after = lambda days: self.first_index(f"({self.span} - age + {days} + CAST(on_mark AS INT))")
        points = [
            f"struct({self.enters} AS idx, 1 AS seen, 1 AS recent, 0 AS historical)",
            # A cell can lie before the recent window of every date it is seen at.
            f"struct(greatest({after(self.recent_days)}, {self.enters}) AS idx, 0 AS seen, -1 AS recent, 0 AS historical)",
            f"struct({after(self.historical_end_days)} AS idx, 0 AS seen, 0 AS recent, 1 AS historical)",
            f"struct({after(self.historical_start_days)} AS idx, 0 AS seen, 0 AS recent, -1 AS historical)",
        ]
        return f"filter(array({', '.join(points)}), x -> x.seen = 1 OR x.idx < {len(self.dates)})"

    def offset_at(self, idx: str) -> str:
        """SQL text: days from the first date to the date with an index."""
        return f"element_at(array({', '.join(f'{o}L' for o in self.offsets)}), {idx} + 1)"

    def weight(self, step: str) -> str:
        """SQL text: ``exp(-days / decay_days)`` of something ``step`` days after the first date, as seen from the last date.

        Sums of these, times ``exp((span - o) / decay_days)``, are the decayed sums at the date o days in: see ``decayed``.
        """
        return f"exp(({step} - {self.span}) / {float(self.decay_days)}D)"

    def decayed(self, total: str) -> str:
        return f"{total} * exp(({self.span} - {self.offset_at('idx')}) / {float(self.decay_days)}D)"

    def along(self, by_idx: DataFrame, running: dict[str, str], final: dict[str, str]) -> DataFrame:
        """From changes per (userId, idx) to one row per (userId, date).

        ``running`` are aggregates over all changes up to an index, ``final`` columns from them at each date. What holds between two
        changes is computed once; a user's rows are bounded by the number of dates.
        """
        so_far = "(PARTITION BY userId ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
        n = len(self.dates)
        stepped = by_idx.selectExpr(
            "userId", "idx", f"lead(idx, 1, {n}) OVER (PARTITION BY userId ORDER BY idx) AS until", *[f"{x} OVER {so_far} AS {c}" for c, x in running.items()]
        )
        dated = stepped.selectExpr("userId", *running, "explode(sequence(idx, until - 1)) AS idx")
        dates = f"array({', '.join(timestamp_sql(d) for d in self.dates)})"
        first = to_millis(self.dates[0])
        return dated.selectExpr(
            "userId",
            f"element_at({dates}, idx + 1) AS obs_date",
            f"{first}L + {self.offset_at('idx')} * {DAY_MS}L AS obs_ms",
            *[f"{x} AS {c}" for c, x in final.items()],
        )

    # --- events -------------------------------------------------------------------------------------

    def up_to_last_date(self, events: DataFrame) -> DataFrame:
        """Drop events after the last date, when dates cut off."""
        return events.where(F.col("ts_ms") <= self.anchor_ms) if self.cutoff else events


def snapshot_events(events: DataFrame, snapshots: Snapshots) -> DataFrame:
    """Every event once per date at or after it (key ``userId, obs_date``).

    The feature plans do not go through this: they reduce events to (user, day) cells first, and those to
    what changes from date to date.
    """
    dates = F.array(*[timestamp_literal(d) for d in snapshots.dates])
    if snapshots.cutoff:
        events = events.where(F.col("ts_ms") <= snapshots.anchor_ms)
        dates = F.filter(dates, lambda d: d >= F.col("ts"))
    return events.select("*", F.explode(dates).alias("obs_date"))
