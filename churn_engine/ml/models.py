"""Classifiers: the pipeline's own parameter names mapped on MLlib, fitting, scoring."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churn_engine.operators.dataset import with_class_weight
from churn_engine.operators.encoding import Dictionary
from churn_engine.operators.metrics import threshold_class
from churn_engine.schema import KEYS, LABEL
from churn_engine.session import materialise
from churn_engine.sources.sinks import write_submission

MAX_DEPTH = 30  # MLlib's limit
KINDS = ("logistic_regression", "decision_tree", "random_forest", "xgboost", "catboost", "neural_network")

#: The multilayer perceptron, which takes scaled features and no weights.
NEURAL_PARAMS: dict[str, Any] = {"hidden_layers": (16, 8), "max_iter": 100}

# The parameters of the untuned models, and the tuned ones, under their usual names.
BASE_PARAMS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"class_weight": "balanced"},
    "decision_tree": {"class_weight": "balanced", "max_depth": 10},
    "random_forest": {"class_weight": "balanced", "max_depth": 10, "n_estimators": 100},
    "xgboost": {"scale_pos_weight": "positive", "n_estimators": 100, "max_depth": 5, "learning_rate": 0.1},
    "catboost": {"scale_pos_weight": "positive", "iterations": 500, "depth": 6, "learning_rate": 0.05},
}
TUNED_PARAMS: dict[str, dict[str, Any]] = {
    "logistic_regression": {
        "C": 0.0004698660599370993,
        "penalty": "l2",
        "solver": "saga",
        "max_iter": 100,
        "class_weight": "balanced",
    },
    "decision_tree": {
        "criterion": "entropy",
        "max_depth": 29,
        "min_samples_split": 7,
        "min_samples_leaf": 6,
        "max_features": None,
        "class_weight": None,
    },
    "random_forest": {
        "n_estimators": 396,
        "criterion": "entropy",
        "max_depth": 31,
        "min_samples_split": 7,
        "min_samples_leaf": 1,
        "max_features": "sqrt",
        "bootstrap": False,
        "class_weight": "balanced",
    },
    "xgboost": {
        "n_estimators": 279,
        "max_depth": 15,
        "learning_rate": 0.08149372019336734,
        "subsample": 0.772049662265316,
        "colsample_bytree": 0.8688411817644643,
        "min_child_weight": 1,
        "gamma": 3.1807321154178306e-05,
        "reg_alpha": 2.8859849941400407e-07,
        "reg_lambda": 0.0366816694677815,
        "booster": "gbtree",
    },
    "catboost": {
        "iterations": 440,
        "depth": 10,
        "learning_rate": 0.12954601614453032,
        "l2_leaf_reg": 2.0405380931054635,
        "border_count": 129,
        "bagging_temperature": 0.6695836288713665,
        "random_strength": 9.459320941234692,
    },
}
# Decision thresholds per model (None: the model's own class).
BASE_THRESHOLDS = {"logistic_regression": None, "decision_tree": None, "xgboost": None, "random_forest": 0.47, "catboost": 0.45}
TUNED_THRESHOLDS = {
    "logistic_regression": 0.54,
    "decision_tree": 0.0001,
    "random_forest": 0.12,
    "xgboost": 0.005,
    "catboost": 0.015,
}


class IgnoredParameter(UserWarning):
    """A parameter has no counterpart in MLlib and is left out."""


@dataclass(frozen=True)
class Mapped:
    """MLlib estimator class, its parameters, the class weight scheme, and what was left out."""

    estimator: type
    params: dict[str, Any]
    weight: str | float | None
    ignored: tuple[str, ...] = field(default=())

    def build(self, features_col: str = "features", label: str = LABEL, weight_col: str = "weight", seed: int = 42, width: int = 0):
        more = {} if self.estimator is LogisticRegression else {"seed": seed}
        params = dict(self.params)
        if self.estimator is MultilayerPerceptronClassifier:
            more["layers"] = [width, *params.pop("hidden"), 2]
        else:
            more["weightCol"] = weight_col
        return self.estimator(featuresCol=features_col, labelCol=label, **more, **params)


def _depth(value: int | None, ignored: list[str]) -> int:
    if value is None:
        return MAX_DEPTH
    if value > MAX_DEPTH:
        ignored.append(f"max_depth={value} (limited to {MAX_DEPTH})")
    return min(int(value), MAX_DEPTH)


def map_params(kind: str, params: Mapping[str, Any], rows: int | None = None) -> Mapped:
    """Translate parameters to MLlib; parameters without a counterpart are named in a warning.

    ``rows`` is the number of rows to be fitted: MLlib averages the loss, so an inverse
    regularisation strength C becomes ``1 / (C * rows)``.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown model {kind!r}; one of {', '.join(KINDS)}")
    left = dict(params)
    ignored: list[str] = []
    weight = left.pop("class_weight", None)
    weight = left.pop("scale_pos_weight", weight)

    def take(name: str, default: Any = None) -> Any:
        return left.pop(name, default)

    if kind == "logistic_regression":
        if rows is None:
            raise ValueError("logistic regression needs the number of rows to scale C")
        penalty = take("penalty", "l2")
        ratio = take("l1_ratio", 0.0)
        mix = {"l1": 1.0, "l2": 0.0, "elasticnet": ratio, None: 0.0}[penalty]
        strength = 0.0 if penalty is None else 1.0 / (take("C", 1.0) * max(rows, 1))
        take("solver")  # MLlib picks its own
        out = {
            "regParam": strength,
            "elasticNetParam": float(mix),
            "maxIter": int(take("max_iter", 100)),
            "standardization": False,
        }
        estimator = LogisticRegression
    elif kind in ("decision_tree", "random_forest"):
        out = {
            "impurity": take("criterion", "gini"),
            "maxDepth": _depth(take("max_depth"), ignored),
            "minInstancesPerNode": int(take("min_samples_leaf", 1)),
        }
        if kind == "decision_tree":
            subset = take("max_features")
            estimator = DecisionTreeClassifier
            if subset is not None:  # a single tree that draws columns is a forest of one
                estimator = RandomForestClassifier
                out |= {"numTrees": 1, "bootstrap": False, "featureSubsetStrategy": subset}
        else:
            estimator = RandomForestClassifier
            out |= {
                "numTrees": int(take("n_estimators", 100)),
                "bootstrap": bool(take("bootstrap", True)),
                "subsamplingRate": float(take("max_samples", 1.0)),
                "featureSubsetStrategy": take("max_features", "sqrt") or "all",
            }
        if take("min_samples_split", 2) != 2:
            ignored.append("min_samples_split")
    elif kind == "xgboost":
        out = {
            "maxIter": int(take("n_estimators", 100)),
            "maxDepth": _depth(take("max_depth", 6), ignored),
            "stepSize": float(take("learning_rate", 0.3)),
            "subsamplingRate": float(take("subsample", 1.0)),
            "featureSubsetStrategy": str(float(take("colsample_bytree", 1.0))),
            "minInstancesPerNode": max(1, int(take("min_child_weight", 1))),
            "minInfoGain": float(take("gamma", 0.0)),
        }
        estimator = GBTClassifier
    elif kind == "neural_network":
        out = {
            "hidden": tuple(int(n) for n in take("hidden_layers", (16, 8))),
            "maxIter": int(take("max_iter", 100)),
            "tol": float(take("tol", 1e-6)),
        }
        estimator = MultilayerPerceptronClassifier
        if weight is not None:
            ignored.append("class_weight")  # oversample instead
            weight = None
    else:
        out = {
            "maxIter": int(take("iterations", 500)),
            "maxDepth": _depth(take("depth", 6), ignored),
            "stepSize": float(take("learning_rate", 0.03)),
            "maxBins": max(2, int(take("border_count", 254))),
            "subsamplingRate": float(take("subsample", 1.0)),
        }
        estimator = GBTClassifier
    ignored += sorted(left)
    if ignored:
        warnings.warn(f"{kind}: no MLlib counterpart for {', '.join(ignored)}", IgnoredParameter, stacklevel=2)
    return Mapped(estimator, out, weight, tuple(ignored))


@dataclass(frozen=True)
class FittedModel:
    """A fitted pipeline with the feature list it was trained on; ``inputs`` names each place of the feature vector."""

    name: str
    kind: str
    features: tuple[str, ...]
    pipeline: PipelineModel
    inputs: tuple[str, ...] = ()

    def predict(self, rows: DataFrame, threshold: float | None = None) -> DataFrame:
        """Rows plus ``score`` (probability of the positive class) and ``prediction``: the model's
        class, or score > threshold."""
        out = self.pipeline.transform(rows).withColumn("score", vector_to_array("probability")[1])
        chosen = F.col("prediction").cast("int") if threshold is None else threshold_class(F.col("score"), threshold)
        helpers = [c for c in out.columns if (c.startswith("_") or c in ("features", "rawPrediction", "probability")) and c not in rows.columns]
        return out.withColumn("prediction", chosen).drop(*helpers)

    def importance(self) -> DataFrame:
        """(feature, importance): split importance of trees, coefficients of logistic regression; a neural network has none."""
        fitted = self.pipeline.stages[-1]
        if self.kind == "neural_network":
            raise ValueError("a neural network has no importance of single features")
        values = fitted.coefficients if self.kind == "logistic_regression" else fitted.featureImportances
        rows = [(name, float(v)) for name, v in zip(self.inputs or self.features, values.toArray(), strict=True)]
        return SparkSession.active().createDataFrame(rows, "feature string, importance double")

    def save(self, path: str) -> None:
        self.pipeline.write().save(path)


def assembler(features: Sequence[str], scale: bool = False, categories: Dictionary | None = None) -> list:
    """Stages that make the feature vector; scaling is off unless asked for. Encoded categories come after the features."""
    stages, vectors = categories.stages() if categories is not None else ([], [])
    if not scale:
        return [*stages, VectorAssembler(inputCols=[*features, *vectors], outputCol="features")]
    return [
        *stages,
        VectorAssembler(inputCols=[*features, *vectors], outputCol="_assembled"),
        StandardScaler(inputCol="_assembled", outputCol="features", withMean=True, withStd=True),
    ]


def one_wave(rows: DataFrame, mapped: Mapped) -> DataFrame:
    """Rows in no more partitions than there are cores, for boosting that draws no rows.

    Each level of a tree is a job in which every partition sums all nodes, columns and bins, whatever its rows, and these sums are shuffled:
    more partitions than run at once only add to them. Where rows are drawn, the draws are those of the partitions, which stay.
    """
    if mapped.estimator is not GBTClassifier or mapped.params["subsamplingRate"] < 1.0:
        return rows
    return rows.coalesce(max(1, rows.sparkSession.sparkContext.defaultParallelism))


def fit(
    rows: DataFrame,
    kind: str,
    params: Mapping[str, Any] | None = None,
    features: Sequence[str] = (),
    label: str = LABEL,
    name: str | None = None,
    seed: int = 42,
    scale: bool | None = None,
    categories: Dictionary | None = None,
) -> FittedModel:
    """Fit one model. MLlib passes over the rows many times: hand in a materialised table (see
    :func:`churn_engine.session.materialise`) when they are costly to compute.

    Class weights and the moments of scaling come from the rows being fitted. Scaling is off, but for a neural network, unless ``scale`` says
    otherwise. ``categories`` adds one-hot vectors of columns; the dictionary is saved with the model.
    """
    if params is None:
        params = NEURAL_PARAMS if kind == "neural_network" else BASE_PARAMS[kind]
    n = rows.count() if kind == "logistic_regression" else None
    mapped = map_params(kind, params, n)
    weighted = one_wave(with_class_weight(rows, mapped.weight, label), mapped)
    inputs = [*features, *(x for c in (categories.values if categories is not None else ()) for x in categories.names(c))]
    estimator = mapped.build(label=label, seed=seed, width=len(inputs))
    wanted = kind == "neural_network" if scale is None else scale
    pipeline = Pipeline(stages=[*assembler(features, wanted, categories), estimator])
    return FittedModel(name or kind, kind, tuple(features), pipeline.fit(weighted), tuple(inputs))


def fit_assembled(vectors: DataFrame, mapped: Mapped, weights: tuple[float, float], label: str, seed: int):
    """MLlib's model of rows whose ``features`` are assembled, classes 0 and 1 weighing ``weights``."""
    weight = F.when(F.col(label) == 1, F.lit(weights[1])).otherwise(F.lit(weights[0]))
    return mapped.build(label=label, seed=seed).fit(one_wave(vectors.withColumn("weight", weight), mapped))


def fit_all(
    rows: DataFrame,
    models: Mapping[str, Mapping[str, Any]],
    features: Sequence[str],
    label: str = LABEL,
    seed: int = 42,
    parallelism: int = 5,
) -> dict[str, FittedModel]:
    """Fit several models (kind -> parameters) on the same, once materialised rows, ``parallelism`` at a time: a fit is many small
    jobs one after the other, and other fits use the cores that these leave."""
    stored = materialise(rows.select(*features, label))

    def one(task: tuple[str, Mapping[str, Any]]) -> FittedModel:
        return fit(stored, *task, features, label, seed=seed)

    with ThreadPool(max(1, min(parallelism, len(models)))) as pool:
        fitted = pool.map(inheritable_thread_target(stored.sparkSession)(one), list(models.items()), chunksize=1)
    return dict(zip(models, fitted, strict=True))


def predictions(
    models: Mapping[str, FittedModel], rows: DataFrame, label: str = LABEL, keep: Sequence[str] = KEYS
) -> DataFrame:
    """Long table (model, seq, keys, label, prediction, score) for the evaluation operators."""
    parts = [
        model.predict(rows).select(
            F.lit(name).alias("model"), F.lit(i).alias("seq"), *keep, F.col(label).alias("label"), "prediction", "score"
        )
        for i, (name, model) in enumerate(models.items())
    ]
    return reduce(DataFrame.unionByName, parts)


def evaluate_model(
    model: FittedModel, rows: DataFrame, threshold: float | None = None, path: str | None = None
) -> DataFrame:
    """Score rows, write the submission if a path is given, and return the predicted positive rate of
    the model's class and of the threshold."""
    own = materialise(model.predict(rows))  # read for the file and for the rates
    chosen = F.col("prediction") if threshold is None else threshold_class(F.col("score"), threshold)
    if path is not None:
        write_submission(own.withColumn("prediction", chosen), path)
    return own.agg(F.avg("prediction").alias("base_rate"), F.avg(chosen).alias("predicted_rate"))
