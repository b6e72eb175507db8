"""Grid search and random search with cross-validation."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churn_engine.ml import linear, trees
from churn_engine.ml.models import MAX_DEPTH, FittedModel, Mapped, assembler, fit, fit_assembled, map_params
from churn_engine.operators.dataset import stratified_folds
from churn_engine.schema import KEYS, LABEL
from churn_engine.session import materialise

#: Fits of a search at the same time, unless told otherwise; more only wait for the driver.
MOST_FITS = 16
#: Kinds that take the assembled features as they are.
TREES = ("decision_tree", "random_forest", "xgboost", "catboost")
#: Spares each fit a pass over its rows to find the classes.
TWO_CLASSES = {"ml_attr": {"type": "nominal", "num_vals": 2}}

# --- search spaces -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Choice:
    options: tuple

    def draw(self, rng: random.Random) -> Any:
        return rng.choice(self.options)


@dataclass(frozen=True)
class Whole:
    low: int
    high: int

    def draw(self, rng: random.Random) -> int:
        return rng.randint(self.low, self.high)


@dataclass(frozen=True)
class Real:
    low: float
    high: float
    log: bool = False

    def draw(self, rng: random.Random) -> float:
        if self.log:
            return math.exp(rng.uniform(math.log(self.low), math.log(self.high)))
        return rng.uniform(self.low, self.high)


@dataclass(frozen=True)
class OnlyIf:
    """Drawn only when an earlier parameter has the given value."""

    parameter: str
    value: Any
    inner: Choice | Whole | Real


Space = Mapping[str, Choice | Whole | Real | OnlyIf]
WEIGHTS = Choice((None, "balanced"))

# Parameter grids and search spaces.
LR_GRID = {"C": [0.01, 1, 5, 50], "penalty": ["l1", "l2"], "class_weight": ["balanced"], "max_iter": [1000]}
CATBOOST_GRID = {
    "iterations": [200, 300, 500],
    "depth": [4, 6, 8],
    "learning_rate": [0.01, 0.03, 0.05, 0.1],
    "l2_leaf_reg": [1, 3, 5, 7],
    "border_count": [32, 64, 128],
    "subsample": [0.7, 0.8, 0.9],
    "scale_pos_weight": ["positive"],
}
XGB_GRID = {
    "max_depth": [3, 5, 7],
    "learning_rate": [0.05, 0.1],
    "n_estimators": [200, 300],
    "subsample": [0.8],
    "colsample_bytree": [0.8],
    "scale_pos_weight": ["positive"],
}
XGB_RANDOM_GRID = {
    "max_depth": [2, 3, 4],
    "learning_rate": [0.03, 0.05, 0.07],
    "n_estimators": [200, 300, 400],
    "min_child_weight": [1, 3, 5],
    "gamma": [0, 0.1, 0.2],
    "subsample": [0.7, 0.8, 0.9],
    "colsample_bytree": [0.7, 0.8, 0.9],
    "reg_alpha": [0, 0.01, 0.1],
    "reg_lambda": [1, 1.5, 2],
    "scale_pos_weight": ["positive"],
}
SPACES: dict[str, Space] = {
    "logistic_regression": {
        "C": Real(1e-4, 1e2, log=True),
        "penalty": Choice(("l1", "l2", "elasticnet")),
        "max_iter": Whole(100, 1000),
        "class_weight": WEIGHTS,
        "l1_ratio": OnlyIf("penalty", "elasticnet", Real(0, 1)),
    },
    "decision_tree": {
        "criterion": Choice(("gini", "entropy")),
        "max_depth": Whole(3, 30),
        "min_samples_split": Whole(2, 20),
        "min_samples_leaf": Whole(1, 10),
        "max_features": Choice(("sqrt", "log2", None)),
        "class_weight": WEIGHTS,
    },
    "random_forest": {
        "n_estimators": Whole(100, 500),
        "criterion": Choice(("gini", "entropy")),
        "max_depth": Whole(5, MAX_DEPTH),  # 50 in the original space, beyond what MLlib builds
        "min_samples_split": Whole(2, 20),
        "min_samples_leaf": Whole(1, 10),
        "max_features": Choice(("sqrt", "log2")),
        "bootstrap": Choice((True, False)),
        "class_weight": WEIGHTS,
        "max_samples": OnlyIf("bootstrap", True, Real(0.5, 1.0)),
    },
    "xgboost": {
        "n_estimators": Whole(100, 500),
        "max_depth": Whole(3, 15),
        "learning_rate": Real(0.01, 0.3, log=True),
        "subsample": Real(0.5, 1.0),
        "colsample_bytree": Real(0.5, 1.0),
        "min_child_weight": Whole(1, 10),
        "gamma": Real(1e-8, 1.0, log=True),
        "reg_alpha": Real(1e-8, 1.0, log=True),
        "reg_lambda": Real(1e-8, 1.0, log=True),
    },
    "catboost": {
        "iterations": Whole(100, 500),
        "depth": Whole(4, 10),
        "learning_rate": Real(0.01, 0.3, log=True),
        "l2_leaf_reg": Real(1, 10),
        "border_count": Whole(32, 255),
        "bagging_temperature": Real(0, 1),
        "random_strength": Real(0, 10),
    },
}
#: Architectures of the neural network to try; the other spaces are fixed values.
SPACES["neural_network"] = {"hidden_layers": Choice(((8,), (16,), (16, 8), (32, 16), (64, 32))), "max_iter": Whole(50, 200)}


def grid(values: Mapping[str, Sequence[Any]]) -> list[dict[str, Any]]:
    """All combinations."""
    return [dict(zip(values, combination, strict=True)) for combination in product(*values.values())]


def sample_grid(values: Mapping[str, Sequence[Any]], n: int, seed: int = 42) -> list[dict[str, Any]]:
    """``n`` different combinations (all, if there are fewer)."""
    total = math.prod(len(options) for options in values.values())
    out = []
    for index in random.Random(seed).sample(range(total), min(n, total)):
        params = {}
        for name, options in values.items():
            index, at = divmod(index, len(options))
            params[name] = options[at]
        out.append(params)
    return out


def draw(space: Space, n: int, seed: int = 42) -> list[dict[str, Any]]:
    """``n`` independent draws from a space."""
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        params: dict[str, Any] = {}
        for name, source in space.items():
            if not isinstance(source, OnlyIf):
                params[name] = source.draw(rng)
            elif params.get(source.parameter) == source.value:
                params[name] = source.inner.draw(rng)
        out.append(params)
    return out


# --- cross-validation --------------------------------------------------------------------------------


@dataclass(frozen=True)
class SearchResult:
    """Candidates with their mean score, best first, and the best one refitted on all rows."""

    kind: str
    candidates: list[dict[str, Any]]
    scores: list[float]
    best: FittedModel

    @property
    def best_params(self) -> dict[str, Any]:
        return self.candidates[0]

    @property
    def best_score(self) -> float:
        return self.scores[0]

    def table(self) -> DataFrame:
        rows = [
            (i + 1, json.dumps(p, sort_keys=True), float(s))
            for i, (p, s) in enumerate(zip(self.candidates, self.scores, strict=True))
        ]
        return SparkSession.active().createDataFrame(rows, "rank int, params string, mean_score double")


def _evaluator(metric: str, label: str):
    if metric == "roc_auc":
        return BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC", numBins=1000)
    if metric == "accuracy":
        return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")
    raise ValueError(f"unknown metric {metric!r}")


def _training_counts(counts: DataFrame, folds: int, label: str) -> list[tuple[int, int]] | None:
    """Rows of classes 0 and 1 in the training part of each fold, and last in all rows; None where a part lacks a class or a label is no class."""
    found = {(r.fold, r[label]): r.n for r in counts.collect()}
    if any(y not in (0, 1) for _, y in found):
        return None
    parts = [tuple(sum(n for (f, y), n in found.items() if f != fold and y == c) for c in (0, 1)) for fold in (*range(folds), None)]
    return parts if all(zero and one for zero, one in parts) else None


def _linear_tasks(parts: list[tuple[int, int]], candidates: Sequence[Mapping[str, Any]]) -> list[linear.Task]:
    """The fits of logistic regressions, by candidate, then fold."""
    tasks = []
    for candidate, (fold, (zero, one)) in product(candidates, enumerate(parts[:-1])):
        mapped = map_params("logistic_regression", candidate, zero + one)
        weights = linear.class_weights(mapped.weight, zero, one)
        p = mapped.params
        tasks.append(linear.Task(fold, weights, weights[0] * zero + weights[1] * one, p["regParam"], p["elasticNetParam"], p["maxIter"]))
    return tasks


def search(
    rows: DataFrame,
    kind: str,
    candidates: Sequence[Mapping[str, Any]],
    features: Sequence[str],
    folds: int = 5,
    metric: str = "accuracy",
    label: str = LABEL,
    key: Sequence[str] = KEYS,
    seed: int = 42,
    parallelism: int | None = None,
) -> SearchResult:
    """Cross-validate every candidate on stratified folds and refit the best on all rows.

    Rows and folds are materialised once. Each fit takes its class weights and the scale of C from the rows
    it is fitted on: the training folds during validation, all rows in the end. Logistic regressions are validated together, to the
    minimum of their objectives: every pass over the rows serves all candidates and folds. Trees and their ensembles read feature vectors
    that are assembled once and cached, weigh them by class counts taken once for all folds, and candidates that MLlib cannot tell apart
    are fitted once. Many single trees validated by accuracy are grown whole by one task each (see :mod:`churn_engine.ml.trees`).
    """
    rows = materialise(rows.select(*key, *features, label))  # the folds read it several times
    stored = materialise(stratified_folds(rows, folds, seed, key, label).drop(*key))
    evaluator = _evaluator(metric, label)

    def validated(task: tuple[Mapping[str, Any], int]) -> float:
        candidate, fold = task
        model = fit(stored.where(F.col("fold") != fold), kind, candidate, features, label, seed=seed)
        return evaluator.evaluate(model.pipeline.transform(stored.where(F.col("fold") == fold)))

    tasks = [(candidate, fold) for candidate in candidates for fold in range(folds)]
    names: list[Any] = list(range(len(candidates)))  # candidates of one name are validated once
    vectors = parts = None
    together = False
    if kind == "logistic_regression" or kind in TREES:
        parts = _training_counts(stored.groupBy("fold", label).agg(F.count(F.lit(1)).alias("n")), folds, label)
    if parts is not None and kind == "logistic_regression":
        columns, points = linear.fit_together(stored, _linear_tasks(parts, candidates), features, label)
        by_fold = points.reshape(len(candidates), folds, -1).swapaxes(0, 1)
        scored = materialise(linear.margins(stored, columns, by_fold, features, label).withColumnRenamed("label", label))

        def validated(task: tuple[int, int]) -> float:
            margin = F.get("margins", F.lit(task[0]))
            part = scored.where(F.col("fold") == task[1]).select(label, margin.alias("rawPrediction"), (margin > 0).cast("double").alias("prediction"))
            return evaluator.evaluate(part)

        tasks = list(product(range(len(candidates)), range(folds)))
    elif parts is not None:
        (assemble,) = assembler(features)
        vectors = assemble.transform(stored).select("features", F.col(label).alias(label, metadata=TWO_CLASSES), "fold").persist()
        mapped = [map_params(kind, candidate) for candidate in candidates]
        names = [(m.estimator, tuple(sorted(m.params.items())), m.weight) for m in mapped]

        def validated(task: tuple[Mapped, int]) -> float:
            model, fold = task
            weights = linear.class_weights(model.weight, *parts[fold])
            fitted = fit_assembled(vectors.where(F.col("fold") != fold), model, weights, label, seed)
            return evaluator.evaluate(fitted.transform(vectors.where(F.col("fold") == fold)))

        distinct = list(dict(zip(names, mapped, strict=True)).values())
        tasks = list(product(distinct, range(folds)))
        grown = [trees.tree_of(m.estimator, m.params, len(features)) for m in distinct]
        # Single trees, of which there are more than would be fitted at once, are grown together where a task can hold all rows.
        together = len(tasks) > MOST_FITS and metric == "accuracy" and all(grown) and sum(parts[-1]) * len(features) <= trees.TASK_BYTES
    # A fit is hundreds of small jobs one after the other: as many fits at once as there are cores keep them busy.
    at_once = parallelism or min(MOST_FITS, max(1, stored.sparkSession.sparkContext.defaultParallelism))
    try:
        found = None
        if together:
            weights = [[linear.class_weights(m.weight, *part) for part in parts[:-1]] for m in distinct]
            found = trees.accuracies(stored, vectors, features, label, folds, grown, weights, sum(parts[-1]), seed)
        if found is not None:
            values = [found[task] for task in product(range(len(distinct)), range(folds))]
        else:
            with ThreadPool(min(at_once, len(tasks))) as pool:
                values = pool.map(inheritable_thread_target(stored.sparkSession)(validated), tasks, chunksize=1)
        by_name = {name: sum(values[i * folds : (i + 1) * folds]) / folds for i, name in enumerate(dict.fromkeys(names))}
        ranked = sorted(zip((by_name[name] for name in names), candidates, strict=True), key=lambda pair: -pair[0])
        if vectors is None:
            best = fit(stored, kind, ranked[0][1], features, label, seed=seed)
        else:
            chosen = map_params(kind, ranked[0][1])
            model = fit_assembled(vectors, chosen, linear.class_weights(chosen.weight, *parts[-1]), label, seed)
            best = FittedModel(kind, kind, tuple(features), PipelineModel([assemble, model]), tuple(features))
    finally:
        if vectors is not None:
            vectors.unpersist()
    return SearchResult(kind, [dict(c) for _, c in ranked], [score for score, _ in ranked], best)


def grid_search(rows: DataFrame, kind: str, values: Mapping[str, Sequence[Any]], features: Sequence[str], **options) -> SearchResult:
    return search(rows, kind, grid(values), features, **options)


def random_search(
    rows: DataFrame, kind: str, space: Space | Mapping[str, Sequence[Any]], features: Sequence[str], n: int = 50, **options
) -> SearchResult:
    """Search over ``n`` draws from a space, or over ``n`` points of a grid of lists."""
    seed = options.get("seed", 42)
    listed = all(isinstance(v, (list, tuple)) for v in space.values())
    candidates = sample_grid(space, n, seed) if listed else draw(space, n, seed)
    return search(rows, kind, candidates, features, **options)


def tune_all(
    rows: DataFrame,
    features: Sequence[str],
    kinds: Sequence[str] = ("catboost",),
    n: int = 100,
    **options,
) -> dict[str, SearchResult]:
    """Random search for each kind of model over its space, by mean accuracy."""
    return {kind: random_search(rows, kind, SPACES[kind], features, n, **options) for kind in kinds}
