"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def code(name: str, codes: dict[str, int]) -> Column:
    """Dictionary encoding; a value outside the dictionary becomes NULL."""
    chain = None
    for value, number in codes.items():
        hit = F.col(name) == value
        chain = F.when(hit, F.lit(number)) if chain is None else chain.when(hit, F.lit(number))
    return chain.cast("int")


def flag(predicate: str) -> str:
    """SQL text: 0/1 of a predicate where NULL counts as false."""
    return f"IF({predicate}, 1, 0)"


def smoothed_ratio(a: str, b: str) -> str:
    """SQL text: ``a / (b + 1)`` as DOUBLE; a zero denominator (only without a cutoff) gives NULL."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE) + 1D)"


def with_exprs(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add columns given as SQL text."""
    return df.withColumns({name: F.expr(text) for name, text in columns.items()})


def fill_zero(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """NULL to 0 in the named numeric columns the frame has; other columns keep their NULLs."""
    zero = {f.name: "0D" if isinstance(f.dataType, T.DoubleType) else "0" for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    return with_exprs(df, {n: f"coalesce({n}, {zero[n]})" for n in names if n in zero})


def digest(parts: Iterable[Column | str], seed: int | str) -> Column:
    """md5 of the key columns and a seed: the same on any partitioning, run or engine."""
    cols = [p if isinstance(p, Column) else F.col(p) for p in parts]
    return F.md5(F.concat_ws("|", *[c.cast("string") for c in cols], F.lit(str(seed))))


def uniform(md5: Column, position: int = 0) -> Column:
    """A number in [0, 1) from 13 hex digits (52 bits) of an md5; ``position`` 0 or 1 picks which."""
    digits = F.substring(md5, 1 + 13 * position, 13)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(1 << 52))
