"""Standard scaling as a fitted operator: moments of the training rows, applied to any rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Moments:
    """Mean and sample standard deviation of each column, as fitted."""

    columns: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]

    def table(self, spark: SparkSession) -> DataFrame:
        """(column, mean, deviation): to be stored with a model."""
        return spark.createDataFrame(list(zip(self.columns, self.means, self.deviations, strict=True)), "column string, mean double, deviation double")

    @classmethod
    def of_table(cls, table: DataFrame) -> Moments:
        rows = table.select("column", "mean", "deviation").orderBy("column").collect()
        return cls(*(tuple(c) for c in zip(*rows, strict=True))) if rows else cls((), (), ())


def fit_moments(train: DataFrame, columns: Sequence[str]) -> Moments:
    """Moments of the columns over rows that have a value, in one aggregate. A column without values has mean 0; one without a second value,
    deviation 0."""
    columns = tuple(dict.fromkeys(columns))
    if not columns:
        return Moments((), (), ())
    row = train.agg(*[f(F.col(c).cast("double")) for f in (F.avg, F.stddev_samp) for c in columns]).first()
    values = [float(v) if v is not None and v == v else 0.0 for v in row]
    return Moments(columns, tuple(values[: len(columns)]), tuple(values[len(columns) :]))


def scaled(rows: DataFrame, moments: Moments) -> DataFrame:
    """``rows`` with ``(x - mean) / deviation`` in place of each fitted column. A column that does not vary becomes 0; NULL stays NULL."""
    out = {}
    for c, mean, deviation in zip(moments.columns, moments.means, moments.deviations, strict=True):
        x = F.col(c).cast("double")
        out[c] = (x - F.lit(mean)) / F.lit(deviation) if deviation > 0 else F.when(x.isNotNull(), F.lit(0.0))
    return rows.withColumns(out) if out else rows
