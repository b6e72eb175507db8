"""Evaluation tables from a long table of predictions.

Input columns: ``model``, ``label`` 0/1, ``prediction`` 0/1 and, for curves, ``score``. Everything
works for many models at once; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churn_engine.functions.running import running_total
from churn_engine.session import materialise


#: Buckets of the running totals. They are cut at quantiles, so none holds much more than its share of the scores.
BUCKETS = 1024


def _cells(scored: DataFrame, prediction: Column | None = None, by: Sequence[str] = ("model",)) -> DataFrame:
    y, p = F.col("label"), F.col("prediction") if prediction is None else prediction
    return scored.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def _safe(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _per_class(hit: Column, missed: Column, wrong: Column) -> dict[str, Column]:
    """Precision, recall, F1 of a class; 0 where undefined."""
    return {
        "precision": _safe(hit, hit + wrong),
        "recall": _safe(hit, hit + missed),
        "f1": _safe(2 * hit, 2 * hit + wrong + missed),
        "support": hit + missed,
    }


def _both_classes() -> tuple[dict[str, Column], dict[str, Column]]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return _per_class(tn, fp, fn), _per_class(tp, fn, fp)


def confusion_matrix(scored: DataFrame) -> DataFrame:
    """Four rows per model (label, prediction, n), zero cells included."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n")) for y, p, c in cells]
    )
    return _cells(scored).select("model", F.inline(rows))


def classification_report(scored: DataFrame) -> DataFrame:
    """Per class, macro average and support-weighted average of precision, recall and F1; accuracy."""
    zero, one = _both_classes()
    total = zero["support"] + one["support"]

    def row(name: str, values: dict[str, Column]) -> Column:
        return F.struct(F.lit(name).alias("class"), *[values[m].alias(m) for m in ("precision", "recall", "f1", "support")])

    names = ("precision", "recall", "f1")
    macro = {m: (zero[m] + one[m]) / 2 for m in names} | {"support": total}
    weighted = {m: _safe(zero[m] * zero["support"] + one[m] * one["support"], total) for m in names} | {"support": total}
    accuracy = {m: _safe(F.col("tn") + F.col("tp"), total) for m in names} | {"support": total}
    rows = [row("0", zero), row("1", one), row("accuracy", accuracy), row("macro avg", macro), row("weighted avg", weighted)]
    return _cells(scored).select("model", F.inline(F.array(*rows)))


def _metrics_of_cells(cells: DataFrame, *keep: str) -> DataFrame:
    zero, one = _both_classes()
    total = zero["support"] + one["support"]
    weighted = {
        m: _safe(zero[m] * zero["support"] + one[m] * one["support"], total).alias(m) for m in ("precision", "recall", "f1")
    }
    return cells.select(
        "model",
        _safe(F.col("tn") + F.col("tp"), total).alias("accuracy"),
        *weighted.values(),
        one["f1"].alias("f1_positive"),
        *keep,
    )


def model_metrics(scored: DataFrame) -> DataFrame:
    """Per model: accuracy and support-weighted precision, recall, F1, plus F1 of the positive class."""
    return _metrics_of_cells(_cells(scored))


def predicted_rate(scored: DataFrame) -> DataFrame:
    """Share of rows predicted positive."""
    return scored.groupBy("model").agg(F.count(F.lit(1)).alias("rows"), F.avg("prediction").alias("predicted_rate"))


def threshold_class(score: Column, threshold: float) -> Column:
    """1 where the score is strictly above the threshold."""
    if isinstance(threshold, bool) or not 0 <= threshold <= 1:
        raise ValueError("a threshold lies in [0, 1]")
    return (score > F.lit(float(threshold))).cast("int")


def threshold_sweep(scored: DataFrame, thresholds: Sequence[float]) -> DataFrame:
    """The confusion cells and their metrics at many thresholds.

    All thresholds are counted in one pass over the rows as conditional counts; only the single row
    per model becomes one row per threshold.
    """
    y, score = F.col("label"), F.col("score")
    above = [threshold_class(score, t) == 1 for t in thresholds]
    counts = scored.groupBy("model").agg(
        F.count_if(y == 0).alias("_neg"),
        F.count_if(y == 1).alias("_pos"),
        *[F.count_if(a & (y == 1)).alias(f"_tp{i}") for i, a in enumerate(above)],
        *[F.count_if(a & (y == 0)).alias(f"_fp{i}") for i, a in enumerate(above)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(float(t)).alias("threshold"),
                F.col(f"_tp{i}").alias("tp"),
                F.col(f"_fp{i}").alias("fp"),
                (F.col("_pos") - F.col(f"_tp{i}")).alias("fn"),
                (F.col("_neg") - F.col(f"_fp{i}")).alias("tn"),
            )
            for i, t in enumerate(thresholds)
        ]
    )
    one = _both_classes()[1]
    total = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return counts.select("model", F.inline(rows)).select(
        "model",
        "threshold",
        "tn",
        "fp",
        "fn",
        "tp",
        _safe(F.col("tp") + F.col("fp"), total).alias("predicted_rate"),
        *[one[m].alias(m) for m in ("precision", "recall", "f1")],
    )


def _by_score(scored: DataFrame) -> DataFrame:
    """One row per (model, score) with the counts of both classes, stored: what follows reads it
    several times, and the scored rows only once."""
    y = F.col("label")
    return materialise(
        scored.groupBy("model", "score").agg(F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    )


def _running(by_score: DataFrame) -> DataFrame:
    """Add running totals ``tp`` and ``fp`` from the highest score down."""
    return running_total(_located(by_score), {"tp": "pos", "fp": "neg"}, -F.col("score"), [-F.col("_bucket")], ["model"]).drop("_bucket")


def _located(by_score: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Add ``_bucket``, ascending with the score. The cuts are approximate quantiles of the distinct scores of all
    models, wherever these lie; only they come to the driver. They decide the balance, never the result."""
    cuts = by_score.approxQuantile("score", [i / buckets for i in range(1, buckets)], 0.2 / buckets)
    splits = [float("-inf"), *sorted(set(cuts)), float("inf")]
    if len(splits) == 2:
        return by_score.withColumn("_bucket", F.lit(0))
    placed = Bucketizer(splits=splits, inputCol="score", outputCol="_bucket", handleInvalid="keep").transform(by_score)
    return placed.withColumn("_bucket", F.col("_bucket").cast("int"))


def roc_curve(scored: DataFrame) -> DataFrame:
    """One point per distinct score (rows at or above it are positive), and the (0, 0) start at an
    infinite threshold."""
    by_score = _by_score(scored)
    totals = by_score.groupBy("model").agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    tpr = F.try_divide(F.col("tp").cast("double"), F.col("_p"))
    fpr = F.try_divide(F.col("fp").cast("double"), F.col("_n"))
    points = _running(by_score).join(totals, "model")
    start = totals.select(
        "model", F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.select("model", F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr")).unionByName(start)


def _area(by_score: DataFrame) -> DataFrame:
    # Pairs (positive, negative) with the negative scored lower, ties half: the positives of a score
    # lose against the negatives above it and half of those beside it.
    sums = _running(by_score).groupBy("model").agg(
        F.sum("pos").alias("_p"),
        F.sum("neg").alias("_n"),
        F.sum(F.col("pos").cast("double") * (F.col("fp") - F.col("neg") / 2.0)).alias("_lost"),
    )
    pairs = F.col("_p").cast("double") * F.col("_n")
    return sums.select("model", F.try_divide(pairs - F.col("_lost"), pairs).alias("auc"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve; a tie counts one half. NULL when a class is missing."""
    return _area(_by_score(scored))


def compare_models(scored: DataFrame) -> DataFrame:
    """Metrics of every model, AUC and whether it is the best by accuracy.

    On equal accuracy the model listed first wins: ``seq`` in the input if present, else the name. The
    scored rows are read once and reduced to counts per (model, score, label, prediction).
    """
    parts = [c for c in ("seq", "score") if c in scored.columns]
    tally = materialise(scored.groupBy("model", "label", "prediction", *parts).agg(F.count(F.lit(1)).alias("n")))
    y, p, n = F.col("label"), F.col("prediction"), F.col("n")

    def total(hit: Column) -> Column:
        return F.sum(F.when(hit, n).otherwise(F.lit(0)))

    cells = tally.groupBy("model").agg(
        total((y == 0) & (p == 0)).alias("tn"),
        total((y == 0) & (p == 1)).alias("fp"),
        total((y == 1) & (p == 0)).alias("fn"),
        total((y == 1) & (p == 1)).alias("tp"),
        (F.min("seq") if "seq" in parts else F.lit(0)).alias("seq"),
    )
    table = _metrics_of_cells(cells, "seq")
    if "score" in parts:
        by_score = tally.groupBy("model", "score").agg(total(y == 1).alias("pos"), total(y == 0).alias("neg"))
        table = table.join(_area(by_score), "model", "left")
    best = Window.orderBy(F.desc("accuracy"), F.asc("seq"), F.asc("model"))  # one row per model
    return table.withColumn("is_best", (F.row_number().over(best) == 1).cast("int"))


def best_model(scored: DataFrame) -> DataFrame:
    """The single best model by accuracy."""
    table = compare_models(scored)
    return table.orderBy(F.desc("accuracy"), "seq", "model").limit(1).drop("is_best")


