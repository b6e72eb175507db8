from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from churn_engine.operators import metrics

FOUR = [("m", 0, 0, 0, 0.1), ("m", 0, 0, 0, 0.4), ("m", 0, 1, 0, 0.35), ("m", 0, 1, 1, 0.8)]
SCHEMA = "model string, seq int, label int, prediction int, score double"


@pytest.fixture(scope="module")
def four(spark):
    return spark.createDataFrame(FOUR, SCHEMA)


def test_confusion_matrix_has_all_cells(spark, four):
    got = {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(four).collect()}
    assert got == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_report(four):
    got = {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in metrics.classification_report(four).collect()}
    assert got["1"] == pytest.approx((1, 0.5, 2 / 3, 2))
    assert got["0"] == pytest.approx((2 / 3, 1, 0.8, 2))
    assert got["weighted avg"] == pytest.approx((0.8333333, 0.75, 0.7333333, 4))
    assert got["macro avg"] == pytest.approx((0.8333333, 0.75, 0.7333333, 4))
    assert got["accuracy"] == pytest.approx((0.75, 0.75, 0.75, 4))


def test_undefined_metrics_are_zero(spark):
    df = spark.createDataFrame([("m", 0, 1, 0, 0.1)], SCHEMA)
    (row,) = metrics.model_metrics(df).collect()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.f1_positive) == (0, 0, 0, 0, 0)


def test_auc_and_ties(spark, four):
    tied = four.withColumns({"model": F.lit("tied"), "score": F.lit(0.5)})
    alone = four.where("label = 1").withColumn("model", F.lit("alone"))
    got = {r.model: r.auc for r in metrics.roc_auc(four.unionByName(tied).unionByName(alone)).collect()}
    assert got == {"m": 0.75, "tied": 0.5, "alone": None}


def test_roc_points(four):
    got = sorted((r.fpr, r.tpr) for r in metrics.roc_curve(four).collect())
    assert got == [(0, 0), (0, 0.5), (0.5, 0.5), (0.5, 1), (1, 1)]


@pytest.mark.parametrize("scale, shift", [(1, 0), (1e-7, 0.5), (1000, -500)])
def test_auc_equals_brute_force(spark, scale, shift):
    """Also with scores crowded into one bucket, and scores outside [0, 1]."""
    rng = random.Random(1)
    data = [(int(rng.random() < 0.3), round(rng.random(), 2) * scale + shift) for _ in range(400)]
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    expected = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame([("m", 0, y, 0, s) for y, s in data], SCHEMA).repartition(6)
    assert metrics.roc_auc(df).first().auc == pytest.approx(expected)
    curve = metrics.roc_curve(df).orderBy(F.desc("threshold")).collect()
    assert [r.tpr for r in curve] == sorted(r.tpr for r in curve)
    assert (curve[-1].fpr, curve[-1].tpr) == (1, 1)


def test_threshold_is_strict_and_checked(spark):
    df = spark.createDataFrame([(0.47,), (0.4700001,)], "s double")
    assert [r[0] for r in df.select(metrics.threshold_class(F.col("s"), 0.47)).collect()] == [0, 1]
    for bad in (-0.1, 1.5, True):
        with pytest.raises(ValueError, match=r"\[0, 1\]"):
            metrics.threshold_class(F.col("s"), bad)


def test_sweep_agrees_with_single_thresholds(four):
    got = {r.threshold: (r.tp, r.fp, r.fn, r.tn) for r in metrics.threshold_sweep(four, [0, 0.35, 1]).collect()}
    assert got == {0.0: (2, 2, 0, 0), 0.35: (1, 1, 1, 1), 1.0: (0, 0, 2, 2)}


def test_first_listed_model_wins_a_tie(spark, four):
    both = four.withColumns({"model": F.lit("b"), "seq": F.lit(0)}).unionByName(four.withColumns({"model": F.lit("a"), "seq": F.lit(1)}))
    assert metrics.best_model(both).first().model == "b"
    table = {r.model: r.is_best for r in metrics.compare_models(both).collect()}
    assert table == {"b": 1, "a": 0}


def test_scores_within_a_billionth_are_split(spark):
    """No bucket of the running totals holds more than a few times its share, wherever the scores lie."""
    close = spark.range(1_000_000).select((F.lit(0.999) + F.col("id") * 1e-15).alias("score"))
    sizes = metrics._located(close.distinct()).groupBy("_bucket").count().agg(F.max("count"), F.count(F.lit(1))).first()
    assert sizes[0] < 4 * 1_000_000 / metrics.BUCKETS
    assert sizes[1] > metrics.BUCKETS / 2
