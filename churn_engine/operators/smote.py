"""Synthetic minority oversampling to class parity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.functions.exprs import digest, uniform
from churn_engine.functions.running import md5_rank
from churn_engine.operators.dataset import train_test_split
from churn_engine.operators.knn import nearest_neighbours
from churn_engine.schema import KEYS, LABEL
from churn_engine.session import materialise


def row_id(key: Sequence[str] = KEYS):
    return F.concat_ws("|", *[F.col(c).cast("string") for c in key])


def minority(rows: DataFrame, label: str = LABEL) -> tuple[int, int, int]:
    """The smaller class (1 if both are equal), its number of rows, and how many it lacks."""
    counts = rows.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    few, many = sorted((counts["p"], counts["n"]))
    return int(counts["p"] <= counts["n"]), few, many - few


def class_rows(
    rows: DataFrame, value: int, features: Sequence[str], key: Sequence[str] = KEYS, label: str = LABEL
) -> DataFrame:
    """Rows of one class as (id, features)."""
    return rows.where(F.col(label) == value).select(row_id(key).alias("id"), *[F.col(c).cast("double").alias(c) for c in features])


def smote_neighbours(
    rows: DataFrame, features: Sequence[str], key: Sequence[str] = KEYS, label: str = LABEL, k: int = 5
) -> DataFrame:
    """The k nearest minority rows of each minority row (exact)."""
    return nearest_neighbours(class_rows(rows, minority(rows, label)[0], features, key, label), features, "id", k)


def synthetic_rows(
    rows: DataFrame,
    features: Sequence[str],
    key: Sequence[str] = KEYS,
    label: str = LABEL,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """(synthetic_id, base, neighbour, gap, label, features) that bring the smaller class to parity. ``rows``
    is read several times and should be stored, as :func:`smote_resample` does.

    Row number s draws its base row, one of its neighbours and the gap from md5s of (s, seed), so a
    lost task redraws the same rows. Only the two class counts come to the driver. A class of ``k`` rows
    or fewer has not that many neighbours: this raises ValueError; pass a smaller ``k``.
    """
    value, size, lacking = minority(rows, label)
    if lacking and size <= k:
        raise ValueError(f"oversampling with k = {k} neighbours needs more than {k} rows of class {value}, found {size}")
    base = class_rows(rows, value, features, key, label)
    numbered = md5_rank(base.withColumn("_md5", digest(["id"], seed)), "_md5", name="_index").drop("_md5")
    near = nearest_neighbours(base, features, "id", k)
    draw = F.col("_draw")
    plan = (
        rows.sparkSession.range(lacking)
        .select(F.col("id").alias("synthetic_id"), digest(["id"], seed).alias("_draw"), digest(["id"], f"{seed}|gap").alias("_gap"))
        .select(
            "synthetic_id",
            (F.floor(uniform(draw, 0) * size) + 1).alias("_index"),
            (F.floor(uniform(draw, 1) * k) + 1).cast("int").alias("rank"),
            uniform(F.col("_gap")).alias("gap"),
        )
    )
    chosen = plan.join(numbered.withColumnRenamed("id", "base"), "_index").join(
        near.select(F.col("id").alias("base"), "rank", "neighbour"), ["base", "rank"]
    )
    other = base.select(F.col("id").alias("neighbour"), *[F.col(c).alias(f"_to_{c}") for c in features])
    moved = [(F.col(c) + F.col("gap") * (F.col(f"_to_{c}") - F.col(c))).alias(c) for c in features]
    own = F.lit(value).cast(rows.schema[label].dataType).alias(label)
    return chosen.join(other, "neighbour").select("synthetic_id", "base", "neighbour", "gap", own, *moved)


def smote_resample(
    rows: DataFrame,
    features: Sequence[str],
    key: Sequence[str] = KEYS,
    label: str = LABEL,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """All rows plus the synthetic ones: (id, features as DOUBLE, label, is_synthetic)."""
    rows = materialise(rows.select(*key, *features, label))  # read for counts, neighbours and values
    originals = rows.select(
        row_id(key).alias("id"),
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label),
        F.lit(0).alias("is_synthetic"),
    )
    made = synthetic_rows(rows, features, key, label, k, seed).select(
        F.concat(F.lit("synthetic|"), F.col("synthetic_id").cast("string")).alias("id"),
        *features,
        label,
        F.lit(1).alias("is_synthetic"),
    )
    return originals.unionByName(made)


def balanced_split(
    rows: DataFrame,
    features: Sequence[str],
    test_share: float = 0.2,
    key: Sequence[str] = KEYS,
    label: str = LABEL,
    k: int = 5,
    seed: int = 42,
    legacy_order: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Training rows oversampled to parity, and untouched test rows.

    ``legacy_order`` oversamples first and splits afterwards, which lets synthetic neighbours of test
    rows into the training part.
    """
    if legacy_order:
        return train_test_split(smote_resample(rows, features, key, label, k, seed), test_share, seed, ["id"])
    train, test = train_test_split(rows, test_share, seed, key)
    originals = test.select(
        row_id(key).alias("id"),
        *[F.col(c).cast("double").alias(c) for c in features],
        F.col(label),
        F.lit(0).alias("is_synthetic"),
    )
    return smote_resample(train, features, key, label, k, seed), originals
