"""One-hot encoding of columns with few values, from a dictionary fitted on training rows."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, StringIndexerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What may happen to a value that the dictionary does not hold.
UNSEEN = ("zeros", "column", "error")


@dataclass(frozen=True)
class Dictionary:
    """The values of each encoded column, most frequent first."""

    values: dict[str, tuple[str, ...]]

    def names(self, column: str) -> list[str]:
        """A column name for each value; values that look alike are told apart by their position."""
        out: list[str] = []
        for i, value in enumerate(self.values[column]):
            name = f"{column}_{re.sub('[^0-9a-z]+', '_', value.lower()).strip('_') or i}"
            out.append(name if name not in out else f"{name}_{i}")
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """(column, value, position): to be stored with a model."""
        rows = [(c, v, i) for c, values in self.values.items() for i, v in enumerate(values)]
        return spark.createDataFrame(rows, "column string, value string, position int")

    @classmethod
    def of_table(cls, table: DataFrame) -> Dictionary:
        values: dict[str, list[str]] = {}
        for r in table.orderBy("column", "position").collect():
            values.setdefault(r["column"], []).append(r["value"])
        return cls({c: tuple(v) for c, v in values.items()})

    def stages(self) -> tuple[list, list[str]]:
        """Pipeline stages that make a sparse vector of each column, and the vectors' names; a value the dictionary does not hold is all zeros."""
        columns = list(self.values)
        indexed, vectors = [f"_{c}_index" for c in columns], [f"_{c}_vector" for c in columns]
        indexer = StringIndexerModel.from_arrays_of_labels([list(self.values[c]) for c in columns], columns, indexed, handleInvalid="keep")
        # The index after the last value stands for all others and is the one that is dropped.
        return [indexer, OneHotEncoder(inputCols=indexed, outputCols=vectors, dropLast=True)], vectors


def fit_dictionary(train: DataFrame, columns: Sequence[str], most: int = 100) -> Dictionary:
    """The values of the columns in ``train``, by falling count, then value. At most ``most`` values a column, else ``ValueError``: a column with many
    values is no category. Values are counted before they are shuffled; ``most + 1`` of a column reach the driver."""
    columns = list(dict.fromkeys(columns))
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    counts = train.select(F.inline(rows)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    order = F.row_number().over(Window.partitionBy("column").orderBy(F.col("n").desc(), "value"))
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in counts.withColumn("place", order).where(F.col("place") <= most + 1).orderBy("column", "place").collect():
        found[r["column"]].append(r["value"])
    for c, values in found.items():
        if len(values) > most:
            raise ValueError(f"column {c!r} has more than {most} values")
    return Dictionary({c: tuple(v) for c, v in found.items()})


def position(dictionary: Dictionary, column: str) -> Column:
    """The position of a row's value in the dictionary; NULL for a value it does not hold and for NULL."""
    values = dictionary.values[column]
    if not values:
        return F.lit(None).cast("int")
    places = F.create_map(*[F.lit(x) for i, v in enumerate(values) for x in (v, i)])
    return F.try_element_at(places, F.col(column).cast("string")).cast("int")


def one_hot(rows: DataFrame, dictionary: Dictionary, unseen: str = "zeros") -> DataFrame:
    """``rows`` and a 0/1 column for each value of the dictionary.

    ``unseen`` tells what a value that the dictionary does not hold does: ``zeros`` in all columns, 1 in a ``column`` of its own
    (``<column>_other``), or an ``error`` when the rows are read. NULL is no value: all zeros.
    """
    if unseen not in UNSEEN:
        raise ValueError(f"unseen is one of {', '.join(UNSEEN)}")
    out = {}
    for c in dictionary.values:
        at, there = position(dictionary, c), F.col(c).isNotNull()
        if unseen == "error":
            at = F.when(there & at.isNull(), F.raise_error(F.concat(F.lit(f"{c}: no such value: "), F.col(c).cast("string"))).cast("int")).otherwise(at)
        out |= {name: F.coalesce((at == i).cast("int"), F.lit(0)) for i, name in enumerate(dictionary.names(c))}
        if unseen == "column":
            out[f"{c}_other"] = (there & at.isNull()).cast("int")
    return rows.withColumns(out) if out else rows
