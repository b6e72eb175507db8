"""From a labelled table to compared models: split, oversample, fit, score at thresholds, compare."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.ml.models import FittedModel, fit_all, predictions
from churn_engine.operators.dataset import train_test_split
from churn_engine.operators.metrics import compare_models, threshold_class
from churn_engine.operators.smote import smote_resample
from churn_engine.schema import KEYS, LABEL
from churn_engine.session import materialise


def at_thresholds(scored: DataFrame, thresholds: Mapping[str, float | None]) -> DataFrame:
    """Predictions of :func:`churn_engine.ml.models.predictions` decided by each model's threshold: score > threshold. A model
    without one keeps its own class."""
    cases = [F.when(F.col("model") == name, threshold_class(F.col("score"), t)) for name, t in thresholds.items() if t is not None]
    return scored.withColumn("prediction", F.coalesce(*cases, F.col("prediction")) if cases else F.col("prediction"))


def experiment(
    rows: DataFrame,
    params: Mapping[str, Mapping[str, Any]],
    features: Sequence[str],
    thresholds: Mapping[str, float | None] | None = None,
    oversample: bool = True,
    label: str = LABEL,
    key: Sequence[str] = KEYS,
    seed: int = 42,
) -> tuple[dict[str, FittedModel], DataFrame, DataFrame]:
    """(fitted models, test predictions, comparison).

    The split comes first, so no synthetic row of the training part knows a test row; only the training part is oversampled, class weights
    come from the rows that are fitted. The comparison has one row per model at its own class and, where ``thresholds`` has
    one, another named ``<model>@<threshold>``. Predictions are stored once and read by all metrics.
    """
    train, test = train_test_split(materialise(rows.select(*key, *features, label)), seed=seed)
    if oversample:
        train = smote_resample(train, features, key=key, label=label, seed=seed)
    fitted = fit_all(train, params, features, label, seed)
    scored = materialise(predictions(fitted, test, label, key))
    chosen = {name: t for name, t in (thresholds or {}).items() if t is not None and name in fitted}
    parts = [scored]
    if chosen:
        decided = at_thresholds(scored.where(F.col("model").isin(*chosen)), chosen)
        names = F.create_map(*[F.lit(x) for name, t in chosen.items() for x in (name, f"{name}@{t}")])
        parts.append(decided.withColumns({"model": F.element_at(names, F.col("model")), "seq": F.col("seq") + len(fitted)}))
    return fitted, scored, compare_models(reduce(DataFrame.unionByName, parts))
