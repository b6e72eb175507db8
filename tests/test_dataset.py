from __future__ import annotations

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from churn_engine.functions.exprs import digest
from churn_engine.functions.running import md5_rank, running_total
from churn_engine.operators import dataset, smote
from churn_engine.operators.knn import nearest_neighbours, visited_blocks


@pytest.fixture(scope="module")
def rows(spark):
    """1000 rows, 10 % positive."""
    return spark.range(1000).select(
        F.col("id").alias("userId"),
        F.expr("TIMESTAMP_NTZ '2018-10-15 00:00:00'").alias("obs_date"),
        (F.col("id") % 10 == 0).cast("int").alias("churned"),
        F.rand(3).alias("x"),
    )


def test_feature_columns_follow_type_and_exclusion(spark):
    schema = "userId bigint, obs_date timestamp_ntz, a int, b double, c string, ts_min timestamp_ntz, total_length double, churned int"
    assert dataset.feature_columns(spark.createDataFrame([], schema)) == ["a", "b"]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "churned int")
    (row,) = dataset.class_counts(df).collect()
    assert row.positive_weight == 3.0
    assert row.balanced_weight_0 == pytest.approx(2 / 3)
    assert row.balanced_weight_1 == 2.0
    weights = {s: [r.weight for r in dataset.with_class_weight(df, s).orderBy("churned").collect()] for s in ("balanced", "positive", None, 5)}
    assert weights["balanced"] == pytest.approx([2 / 3] * 3 + [2.0])
    assert weights["positive"] == [1, 1, 1, 3]
    assert weights[None] == [1, 1, 1, 1]
    assert weights[5] == [1, 1, 1, 5]
    with pytest.raises(ValueError, match="unknown class weight"):
        dataset.with_class_weight(df, "other")


def test_split_is_stable_and_complete(rows):
    train, test = dataset.train_test_split(rows)
    assert train.count() + test.count() == 1000
    assert 150 < test.count() < 250
    again = dataset.train_test_split(rows.repartition(7))[1]
    assert {r.userId for r in again.collect()} == {r.userId for r in test.collect()}


def test_stratified_folds_keep_the_class_ratio(rows):
    counts = dataset.stratified_folds(rows.repartition(5), 5).groupBy("fold", "churned").count().collect()
    assert {(r.fold, r.churned): r["count"] for r in counts} == {(f, c): 180 if c == 0 else 20 for f in range(5) for c in (0, 1)}


def test_folds_keep_rows_without_label(spark, rows):
    unlabelled = rows.withColumn("churned", F.when(F.col("userId") > 900, None).otherwise(F.col("churned")))
    assert dataset.stratified_folds(unlabelled, 3).count() == 1000


def test_user_folds_keep_users_together(rows):
    both = rows.unionByName(rows.withColumn("obs_date", F.expr("TIMESTAMP_NTZ '2018-10-20 00:00:00'")))
    folds = dataset.user_folds(both, 4).groupBy("userId").agg(F.countDistinct("fold").alias("n"))
    assert folds.where("n > 1").count() == 0


def test_rank_equals_a_global_row_number(rows):
    marked = rows.withColumn("h", digest(["userId"], 1))
    got = {r.h: r["rank"] for r in md5_rank(marked, "h").collect()}
    assert got == {h: i + 1 for i, h in enumerate(sorted(got))}


@pytest.mark.parametrize("levels", [["floor(x * 4)"], ["floor(x * 2)", "floor(x * 64)"], ["0"]])
def test_running_total_does_not_depend_on_the_buckets(rows, levels):
    out = running_total(rows, {"upto": "userId"}, F.col("x"), [F.expr(level) for level in levels]).orderBy("x").collect()
    assert [r.upto for r in out] == list(np.cumsum([r.userId for r in out]))


def brute_force(ids, x, k):
    d2 = np.zeros((len(x), len(x)))
    for j in range(x.shape[1]):
        d2 += (x[:, j, None] - x[None, :, j]) ** 2
    np.fill_diagonal(d2, np.inf)
    return {
        (ids[i], rank + 1): (ids[j], round(float(np.sqrt(d2[i, j])), 9))
        for i in range(len(x))
        for rank, j in enumerate([j for _, _, j in sorted((d2[i, j], ids[j], j) for j in range(len(x)) if j != i)][:k])
    }


@pytest.mark.parametrize("shape, block", [("spread", 1000), ("spread", 30), ("copies", 30), ("line", 30)])
def test_neighbours_equal_brute_force(spark, shape, block):
    rng = np.random.default_rng(5)
    n = 240
    x = np.round(rng.normal(size=(n, 4)) * [50, 5, 1, 0.1], 3)
    if shape == "copies":
        x[: n // 3] = x[0]  # a third of the rows are the same vector
        x[100:103] = x[200]  # a small group, fewer than k copies
    if shape == "line":
        x[:, 0] = 1.0
        x[:, 1:] = np.round(x[:, 1:], 0)  # few distinct values, many ties
    ids = [f"r{i:04d}" for i in range(n)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")).assign(id=ids)).repartition(3)
    got = nearest_neighbours(df, list("abcd"), k=5, block=block).collect()
    assert {(r.id, r["rank"]): (r.neighbour, round(r.distance, 9)) for r in got} == brute_force(ids, x, 5)


def test_neighbours_of_fewer_points_than_k(spark):
    df = spark.createDataFrame([("a", 0.0), ("b", 1.0), ("c", 3.0)], "id string, v double")
    got = {(r.id, r["rank"], r.neighbour) for r in nearest_neighbours(df, ["v"], k=5).collect()}
    assert got == {("a", 1, "b"), ("a", 2, "c"), ("b", 1, "a"), ("b", 2, "c"), ("c", 1, "b"), ("c", 2, "a")}


@pytest.fixture(scope="module")
def imbalanced(spark):
    rng = random.Random(9)
    data = [(i, int(i < 12), rng.gauss(0, 1) + 3 * (i < 12), rng.gauss(0, 10)) for i in range(100)]
    return spark.createDataFrame(data, "userId bigint, churned int, f double, g double")


def test_oversampling_reaches_parity_within_bounds(imbalanced):
    out = smote.smote_resample(imbalanced, ["f", "g"], ["userId"])
    counts = {(r.churned, r.is_synthetic): r["count"] for r in out.groupBy("churned", "is_synthetic").count().collect()}
    assert counts == {(0, 0): 88, (1, 0): 12, (1, 1): 76}
    real = imbalanced.where("churned = 1").agg(F.min("f"), F.max("f"), F.min("g"), F.max("g")).first()
    made = out.where("is_synthetic = 1").agg(F.min("f"), F.max("f"), F.min("g"), F.max("g")).first()
    assert real[0] <= made[0] and made[1] <= real[1] and real[2] <= made[2] and made[3] <= real[3]


def test_oversampling_is_reproducible(imbalanced):
    a = smote.smote_resample(imbalanced, ["f", "g"], ["userId"])
    b = smote.smote_resample(imbalanced.repartition(9), ["f", "g"], ["userId"])
    assert a.exceptAll(b).count() == 0
    other = smote.smote_resample(imbalanced, ["f", "g"], ["userId"], seed=1)
    assert a.exceptAll(other).count() > 0


def test_synthetic_rows_lie_between_base_and_neighbour(imbalanced):
    near = {(r.id, r.neighbour) for r in smote.smote_neighbours(imbalanced, ["f", "g"], ["userId"]).collect()}
    values = {str(r.userId): r.f for r in imbalanced.collect()}
    for r in smote.synthetic_rows(imbalanced, ["f", "g"], ["userId"]).collect():
        assert (r.base, r.neighbour) in near
        assert r.f == pytest.approx(values[r.base] + r.gap * (values[r.neighbour] - values[r.base]))


def test_split_before_oversampling(imbalanced):
    train, test = smote.balanced_split(imbalanced, ["f", "g"], key=["userId"])
    assert test.where("is_synthetic = 1").count() == 0
    assert train.where("churned = 1").count() == train.where("churned = 0").count()
    legacy_train, legacy_test = smote.balanced_split(imbalanced, ["f", "g"], key=["userId"], legacy_order=True)
    assert legacy_train.count() + legacy_test.count() == 176


def test_class_zero_as_the_minority(imbalanced):
    flipped = imbalanced.withColumn("churned", 1 - F.col("churned"))
    out = smote.smote_resample(flipped, ["f", "g"], ["userId"])
    expected = smote.smote_resample(imbalanced, ["f", "g"], ["userId"]).withColumn("churned", 1 - F.col("churned"))
    assert out.exceptAll(expected).count() == 0 and expected.exceptAll(out).count() == 0


def test_equal_classes_stay_as_they_are(imbalanced):
    even = imbalanced.where("userId < 24")
    assert smote.smote_resample(even, ["f", "g"], ["userId"]).count() == 24


def test_too_few_rows_for_k(imbalanced):
    few = imbalanced.where("userId >= 9")  # three of class 1
    with pytest.raises(ValueError, match="k = 5 .* class 1, found 3"):
        smote.smote_resample(few, ["f", "g"], ["userId"])
    made = smote.smote_resample(few, ["f", "g"], ["userId"], k=2)
    assert made.where("churned = 1").count() == made.where("churned = 0").count() == 88


def test_search_prunes_in_every_direction(spark):
    """Clusters that lie apart in some columns each: a block's neighbours are few, whichever column parts them."""
    rng = np.random.default_rng(11)
    middles = rng.choice([-50.0, 0.0, 50.0], size=(40, 6))
    x = middles[rng.integers(0, 40, 2000)] + rng.normal(size=(2000, 6))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcdef")).assign(id=[f"r{i:04d}" for i in range(2000)]))
    seen = visited_blocks(df, list("abcdef"), block=50)
    assert seen["vectors"] == 2000 and seen["blocks"] >= 40 and seen["visits"] < 2000 * 39 / 8
    got = nearest_neighbours(df, list("abcdef"), block=50).collect()
    assert {(r.id, r["rank"]): (r.neighbour, round(r.distance, 9)) for r in got} == brute_force([f"r{i:04d}" for i in range(2000)], x, 5)
