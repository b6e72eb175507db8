"""Running totals and contiguous ranks without a window that sees the whole table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(
    df: DataFrame,
    totals: dict[str, str],
    order: Column,
    levels: Sequence[Column],
    by: Sequence[str] = (),
) -> DataFrame:
    """Add inclusive running totals of ``totals`` (new name -> column) in ascending ``order``.

    ``levels`` are coarse-to-fine integer prefixes of ``order`` (ascending with it). The total before
    a row is the sum over earlier buckets at each level, taken from grouped counts, plus a window
    inside the finest bucket. So no task ever sees more than one bucket, and the bucket choice
    affects balance only, never the result. The first level must have a fixed number of buckets (a few
    thousand); its offsets are small and AQE may broadcast them.
    """
    names = [f"_level{i}" for i in range(len(levels))]
    result = out = df.withColumns(dict(zip(names, levels, strict=True)))
    before = {new: F.lit(0) for new in totals}
    for i, name in enumerate(names):
        prefix = [*by, *names[: i + 1]]
        parent = [*by, *names[:i]]
        sums = out.groupBy(*prefix).agg(*[F.sum(col).alias(f"_s_{new}") for new, col in totals.items()])
        earlier = Window.partitionBy(*(parent or [F.lit(0)])).orderBy(name).rowsBetween(Window.unboundedPreceding, -1)
        keys = {column: f"_k{i}_{column}" for column in prefix}
        offsets = sums.select(
            *[F.col(column).alias(key) for column, key in keys.items()],
            *[F.coalesce(F.sum(f"_s_{new}").over(earlier), F.lit(0)).alias(f"_o{i}_{new}") for new in totals],
        )
        same = reduce(Column.__and__, [F.col(column).eqNullSafe(F.col(key)) for column, key in keys.items()])
        result = result.join(offsets, same).drop(*keys.values())
        before = {new: before[new] + F.col(f"_o{i}_{new}") for new in totals}
    inside = Window.partitionBy(*by, *names).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    result = result.withColumns({new: before[new] + F.sum(col).over(inside) for new, col in totals.items()})
    return result.drop(*names, *[f"_o{i}_{new}" for i in range(len(levels)) for new in totals])


def md5_rank(df: DataFrame, md5: str, by: Sequence[str] = (), name: str = "rank", digits: int = 3) -> DataFrame:
    """Contiguous 1-based rank by an md5 column, equal to ``row_number`` ordered by it.

    The leading hex digits are order-preserving buckets of even size, so each bucket is ranked by
    its own task; three digits are 4096 buckets, enough for some ten billion rows, and every further digit
    (up to 15) makes 16 times as many. It decides the balance, never the result.
    """
    prefix = F.conv(F.substring(F.col(md5), 1, digits), 16, 10).cast("bigint")
    return running_total(df.withColumn("_one", F.lit(1)), {name: "_one"}, F.col(md5), [prefix], by).drop("_one")
