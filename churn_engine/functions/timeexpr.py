"""Time arithmetic on epoch milliseconds (64-bit integers, so no time-zone setting can change it)."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MS = 86_400_000
EPOCH = datetime(1970, 1, 1)


def parse_date(value: str | date | datetime) -> datetime:
    """A parameter date as a naive (UTC) datetime."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value)
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        raise ValueError("dates are naive and mean UTC")
    if value.microsecond % 1000:
        raise ValueError("dates have millisecond resolution, as the log has")
    return value


def to_millis(value: str | date | datetime) -> int:
    return (parse_date(value) - EPOCH) // timedelta(milliseconds=1)


def timestamp_sql(value: date | datetime) -> str:
    return f"TIMESTAMP_NTZ '{parse_date(value).isoformat(sep=' ', timespec='milliseconds')}'"


def timestamp_literal(value: date | datetime) -> Column:
    return F.expr(timestamp_sql(value))


# The rest is SQL text, to be put into larger expressions.


def millis_of(ntz: str) -> str:
    """Epoch milliseconds of a TIMESTAMP_NTZ."""
    return f"timestampdiff(MILLISECOND, {timestamp_sql(EPOCH)}, {ntz})"


def timestamp_of(ms: str) -> str:
    """TIMESTAMP_NTZ of epoch milliseconds."""
    return f"timestampadd(MILLISECOND, {ms}, {timestamp_sql(EPOCH)})"


def floor_div(value: str, unit: int = DAY_MS) -> str:
    """Floor division of a BIGINT, also below zero.

    The quotient is off by less than half a part in ``unit`` for values below 2**52 (in milliseconds,
    140,000 years), so its floor is exact.
    """
    return f"floor(({value}) / {float(unit)}D)"


def days_between(later_ms: str, earlier_ms: str) -> str:
    """Elapsed 24-hour days, rounded down: 12 hours ago is 0, 6 hours ahead is -1."""
    return floor_div(f"{later_ms} - {earlier_ms}")
