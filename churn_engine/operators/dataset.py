"""Model inputs: feature choice, weights, splits, folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churn_engine.functions.exprs import digest, uniform
from churn_engine.functions.running import md5_rank
from churn_engine.schema import CARRIED, KEYS, LABEL


def feature_columns(df: DataFrame, exclude: Sequence[str] = (*KEYS, LABEL, *CARRIED)) -> list[str]:
    """Numeric columns in schema order, minus keys, label and carried columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def project_features(df: DataFrame, features: Sequence[str], extra: Sequence[str] = KEYS) -> DataFrame:
    """Project any rows onto the feature list of the training set."""
    return df.select(*extra, *features)


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    """One row: negatives, positives, their ratio, and the balanced weight of each class."""
    n = F.col("negatives") + F.col("positives")
    return (
        df.groupBy()
        .agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
        .select(
            "negatives",
            "positives",
            F.try_divide(F.col("negatives"), F.col("positives")).alias("positive_weight"),
            F.try_divide(n, 2 * F.col("negatives")).alias("balanced_weight_0"),
            F.try_divide(n, 2 * F.col("positives")).alias("balanced_weight_1"),
        )
    )


def with_class_weight(df: DataFrame, scheme: str | None, label: str = LABEL, name: str = "weight") -> DataFrame:
    """Add a row weight: ``balanced`` (n / 2n_class), ``positive`` (negatives / positives on the
    positive class), a number (that weight on the positive class) or None (1).

    The class counts are one row, joined by broadcast; always taken from the rows to be fitted.
    """
    if scheme is None:
        return df.withColumn(name, F.lit(1.0))
    if isinstance(scheme, (int, float)):
        return df.withColumn(name, F.when(F.col(label) == 1, F.lit(float(scheme))).otherwise(F.lit(1.0)))
    pairs = {
        "balanced": (F.col("balanced_weight_0"), F.col("balanced_weight_1")),
        "positive": (F.lit(1.0), F.col("positive_weight")),
    }
    if scheme not in pairs:
        raise ValueError(f"unknown class weight {scheme!r}")
    zero, one = pairs[scheme]
    counts = class_counts(df, label).select(zero.alias("_w0"), one.alias("_w1"))
    weight = F.when(F.col(label) == 1, F.col("_w1")).otherwise(F.col("_w0"))
    return df.crossJoin(F.broadcast(counts)).withColumn(name, weight).drop("_w0", "_w1")


def hash_split(
    df: DataFrame, test_share: float = 0.2, seed: int = 42, key: Sequence[str] = KEYS, name: str = "is_test"
) -> DataFrame:
    """Random split decided by an md5 of the key: the same rows on every run and partitioning."""
    return df.withColumn(name, (uniform(digest(key, seed)) < test_share).cast("int"))


def train_test_split(
    df: DataFrame, test_share: float = 0.2, seed: int = 42, key: Sequence[str] = KEYS
) -> tuple[DataFrame, DataFrame]:
    marked = hash_split(df, test_share, seed, key)
    return (
        marked.where(F.col("is_test") == 0).drop("is_test"),
        marked.where(F.col("is_test") == 1).drop("is_test"),
    )


def stratified_folds(
    df: DataFrame, k: int = 5, seed: int = 42, key: Sequence[str] = KEYS, label: str | None = LABEL, name: str = "fold"
) -> DataFrame:
    """Fold number 0..k-1, shuffled, equal per class to within one row.

    The rank by md5 within a class is put together from counts of md5 prefixes, so no task sorts a
    whole class. ``label=None`` gives plain folds.
    """
    marked = df.withColumn("_md5", digest(key, seed))
    ranked = md5_rank(marked, "_md5", [label] if label else [], "_rank")
    return ranked.withColumn(name, F.pmod(F.col("_rank") - 1, F.lit(k)).cast("int")).drop("_md5", "_rank")


def user_folds(df: DataFrame, k: int = 5, seed: int = 42, user: str = "userId", name: str = "fold") -> DataFrame:
    """Folds that keep all snapshots of a user together."""
    return df.withColumn(name, F.floor(uniform(digest([user], seed)) * k).cast("int"))
