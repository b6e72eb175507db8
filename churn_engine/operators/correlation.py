"""Correlations of all pairs of columns from one aggregate of co-moments.

A first pass takes the means. The second sums, for every pair of columns, products of what is left after taking the means off: tasks
multiply bounded blocks of rows with themselves and hand on one set of sums each, and sums of sums are plain aggregates. Where a pair has NULLs or NaNs,
only the rows that hold both columns count, as in SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have this package: the task function travels with the plan.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SUMS = ("n", "x", "y", "xx", "yy", "xy")
#: Rows that are multiplied at a time.
ROWS = 8192


def _comoments(columns: Sequence[str], means: Sequence[float]):
    shift = np.array(means)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(columns)
        sums = {name: np.zeros((k, k)) for name in SUMS}
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                # NULL becomes NaN.
                x = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in part.columns], axis=1)
                there = np.isfinite(x)
                x = np.where(there, x - shift, 0.0)
                there = there.astype(float)
                square = x * x
                for name, a, b in (("n", there, there), ("x", x, there), ("y", there, x), ("xx", square, there), ("yy", there, square), ("xy", x, x)):
                    sums[name] += a.T @ b
        i, j = np.triu_indices(k, 1)
        out = {"a": i.astype(np.int32), "b": j.astype(np.int32), **{name: m[i, j] for name, m in sums.items()}}
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in out.values()], names=list(out))

    return run


def comoments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(a, b, n, x, y, xx, yy, xy): for every pair a < b of positions in ``columns`` the mergeable sums over rows that hold both."""
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    means = numbers.agg(*[F.avg(F.when(F.abs(c) < float("inf"), F.col(c))).alias(c) for c in columns]).first()
    run = _comoments(list(columns), [means[c] or 0.0 for c in columns])
    schema = "a int, b int, " + ", ".join(f"{s} double" for s in SUMS)
    return numbers.mapInArrow(run, schema).groupBy("a", "b").agg(*[F.sum(s).alias(s) for s in SUMS])


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a, b, n, correlation``: Pearson's correlation of every pair of columns, each pair once, in the order of ``columns``.

    A column that does not vary over the rows of a pair, or a pair with fewer than two rows, has a NULL correlation. NULL, NaN and infinite values
    do not count. The sums of all pairs, of fixed size, are what is shuffled.
    """
    columns = list(dict.fromkeys(columns))
    name = F.array(*[F.lit(c) for c in columns])
    spread = lambda square, total: F.col(square) - F.col(total) * F.col(total) / F.col("n")
    # Rounding leaves a little of the squares where a column does not vary.
    varies = lambda square, total: spread(square, total) > 1e-12 * F.col(square)
    shared = F.col("xy") - F.col("x") * F.col("y") / F.col("n")
    value = F.when((F.col("n") >= 2) & varies("xx", "x") & varies("yy", "y"), shared / F.sqrt(spread("xx", "x") * spread("yy", "y")))
    return comoments(df, columns).select(
        F.get(name, F.col("a")).alias("a"), F.get(name, F.col("b")).alias("b"), F.col("n").cast("long").alias("n"), value.alias("correlation")
    )


def correlation_with(df: DataFrame, target: str, columns: Sequence[str]) -> DataFrame:
    """``feature, n, correlation`` with one target column, a label say; order by ``abs(correlation)`` to see what matters most."""
    columns = [c for c in dict.fromkeys(columns) if c != target]
    matrix = correlation_matrix(df, [target, *columns]).where(F.col("a") == target)
    return matrix.select(F.col("b").alias("feature"), "n", "correlation")
