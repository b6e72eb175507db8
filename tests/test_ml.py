from __future__ import annotations

import json
import os
import subprocess
import sys
import warnings

import numpy as np
import pandas as pd
import pytest
from pyspark import cloudpickle
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.sql import functions as F

from churn_engine.ml import linear, models, trees, tuning
from churn_engine.operators import dataset, encoding, metrics, scaling
from churn_engine.plans.experiment import experiment
from churn_engine.sources import sinks

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """A planted signal: the label follows a, with noise; b and c are noise."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + 0.5 * rng.normal(size=300) > 0.8).astype(int)
    pdf = pd.DataFrame(x, columns=FEATURES).assign(churned=y, userId=np.arange(300), obs_date=pd.Timestamp("2018-10-15"))
    df = spark.createDataFrame(pdf).withColumns(
        {"churned": F.col("churned").cast("int"), "obs_date": F.col("obs_date").cast("timestamp_ntz")}
    )
    return df.coalesce(2).cache()


SMALL = {
    "logistic_regression": {"class_weight": "balanced"},
    "decision_tree": {"class_weight": "balanced", "max_depth": 4},
    "random_forest": {"class_weight": "balanced", "max_depth": 4, "n_estimators": 10},
    "xgboost": {"scale_pos_weight": "positive", "n_estimators": 5, "max_depth": 2, "learning_rate": 0.3},
    "catboost": {"scale_pos_weight": "positive", "iterations": 5, "depth": 2, "border_count": 16},
    "neural_network": {"hidden_layers": (4,), "max_iter": 40},
}


@pytest.fixture(scope="module")
def fitted(rows):
    return models.fit_all(rows, SMALL, FEATURES)


def test_every_model_finds_the_signal(rows, fitted):
    scored = models.predictions(fitted, rows)
    assert scored.columns == ["model", "seq", "userId", "obs_date", "label", "prediction", "score"]
    auc = {r.model: r.auc for r in metrics.roc_auc(scored).collect()}
    assert set(auc) == set(models.KINDS)
    assert min(auc.values()) > 0.85
    for model in fitted.values():
        if model.kind == "neural_network":
            continue
        top = model.importance().orderBy(F.desc(F.abs("importance"))).first()
        assert top.feature == "a"


def test_fit_is_deterministic(rows, fitted):
    again = models.fit(rows, "random_forest", SMALL["random_forest"], FEATURES)
    a = fitted["random_forest"].predict(rows).select("userId", F.round("score", 9)).collect()
    assert sorted(a) == sorted(again.predict(rows).select("userId", F.round("score", 9)).collect())


@pytest.mark.parametrize("kind", ["catboost", "xgboost"])
def test_a_level_of_a_tree_is_one_wave_of_tasks(rows, spark, fitted, kind):
    """Each partition sums all nodes, so there are no more of them than cores; the model stays the same."""
    context = spark.sparkContext
    cores = context.defaultParallelism
    context.setJobGroup(f"wave-{kind}", "")
    model = models.fit(rows.repartition(5 * cores), kind, SMALL[kind], FEATURES)
    context.setLocalProperty("spark.jobGroup.id", None)
    status = context.statusTracker()
    stages = [status.getStageInfo(s) for j in status.getJobIdsForGroup(f"wave-{kind}") for s in status.getJobInfo(j).stageIds]
    levels = [s.numTasks for s in stages if s is not None and "RandomForest" in s.name]
    assert levels and max(levels) <= cores
    a, b = ({r.userId: r.score for r in m.predict(rows).collect()} for m in (model, fitted[kind]))
    assert a == pytest.approx(b, abs=1e-6)


def test_threshold_scoring_and_submission(rows, fitted, spark, tmp_path):
    model = fitted["random_forest"]
    scored = model.predict(rows, 0.47)
    assert scored.where((F.col("score") > 0.47) != (F.col("prediction") == 1)).count() == 0
    (rates,) = models.evaluate_model(model, rows, 0.47, str(tmp_path / "out")).collect()
    assert rates.predicted_rate == pytest.approx(scored.agg(F.avg("prediction")).first()[0])
    back = spark.read.option("header", True).schema("id bigint, target int").csv(str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect())) == sorted((r.userId, r.prediction) for r in scored.collect())
    sinks.write_submission(scored, str(tmp_path / "renamed"), "userId", "prediction")
    assert spark.read.option("header", True).csv(str(tmp_path / "renamed")).columns == ["userId", "prediction"]
    with pytest.raises(ValueError):
        model.predict(rows, 2.0)


def test_logistic_regression_minimises_the_c_form(rows):
    """At the optimum the gradient of ``C * weighted loss + |w|^2 / 2`` vanishes."""
    c = 0.01
    model = models.fit(rows, "logistic_regression", {"class_weight": "balanced", "C": c, "max_iter": 500}, FEATURES)
    assert c_form_gradient(rows, model, c) < 1e-3


def test_parameters_without_a_twin_are_named():
    with pytest.warns(models.IgnoredParameter, match="min_samples_split, reg|max_depth=31"):
        mapped = models.map_params("random_forest", models.TUNED_PARAMS["random_forest"])
    assert mapped.params["maxDepth"] == 30
    assert "min_samples_split" in mapped.ignored
    with pytest.warns(models.IgnoredParameter, match="booster, reg_alpha, reg_lambda"):
        models.map_params("xgboost", models.TUNED_PARAMS["xgboost"])
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        for kind, params in models.BASE_PARAMS.items():
            models.map_params(kind, params, rows=10)
    with pytest.raises(ValueError, match="unknown model"):
        models.map_params("other", {})


def test_tree_that_draws_columns():
    assert models.map_params("decision_tree", {"max_features": None}).estimator is DecisionTreeClassifier
    mapped = models.map_params("decision_tree", {"max_features": "sqrt"})
    assert mapped.estimator is RandomForestClassifier
    assert mapped.params["numTrees"] == 1


def test_grid_sizes():
    assert len(tuning.grid(tuning.LR_GRID)) == 8  # 16 with two solvers, a choice MLlib makes itself
    assert len(tuning.grid(tuning.CATBOOST_GRID)) == 1296
    assert len(tuning.grid(tuning.XGB_GRID)) == 12
    drawn = tuning.sample_grid(tuning.XGB_RANDOM_GRID, 50)
    assert len({json.dumps(d, sort_keys=True) for d in drawn}) == 50
    assert drawn == tuning.sample_grid(tuning.XGB_RANDOM_GRID, 50)


@pytest.mark.parametrize("kind", models.KINDS)
def test_draws_stay_in_the_space(kind):
    for params in tuning.draw(tuning.SPACES[kind], 200, seed=3):
        for name, source in tuning.SPACES[kind].items():
            if isinstance(source, tuning.OnlyIf):
                assert (name in params) == (params[source.parameter] == source.value)
                source = source.inner
            if name in params:
                value = params[name]
                inside = value in source.options if isinstance(source, tuning.Choice) else source.low <= value <= source.high
                assert inside


def test_grid_search(rows):
    grid = {"C": [1e-6, 1.0], "penalty": ["l1", "l2"], "class_weight": ["balanced"]}
    found = tuning.grid_search(rows, "logistic_regression", grid, FEATURES, folds=3, metric="roc_auc")
    assert found.best_params["C"] == 1.0
    assert found.scores == sorted(found.scores, reverse=True)
    assert found.best_score > 0.85
    table = found.table().collect()
    assert [r["rank"] for r in table] == [1, 2, 3, 4]
    assert found.best.predict(rows).count() == 300


def c_form_gradient(rows, model, c):
    pdf = rows.toPandas()
    x, y = pdf[FEATURES].to_numpy(), pdf["churned"].to_numpy()
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
    w, b = model.pipeline.stages[-1].coefficients.toArray(), model.pipeline.stages[-1].intercept
    p = 1 / (1 + np.exp(-(x @ w + b)))
    return np.abs(c * (x * (weight * (p - y))[:, None]).sum(axis=0) + w).max()


def test_the_best_is_refitted_for_all_rows(rows):
    grid = {"C": [0.01], "penalty": ["l2"], "class_weight": ["balanced"], "max_iter": [500]}
    found = tuning.grid_search(rows, "logistic_regression", grid, FEATURES, folds=3)
    assert c_form_gradient(rows, found.best, 0.01) < 1e-3


def test_logistic_regressions_are_validated_together(rows, monkeypatch):
    """Each reaches the minimum of its own objective, under either penalty, and only the best is fitted by itself."""
    single, calls, fits = tuning.fit, [], []
    monkeypatch.setattr(tuning, "fit", lambda *x, **y: calls.append(x[2]) or single(*x, **y))
    together = linear.fit_together
    monkeypatch.setattr(linear, "fit_together", lambda *x: fits.append((x[0], x[1], together(*x))) or fits[-1][2])
    grid = {"C": [0.01, 1.0], "penalty": ["l1", "l2"], "class_weight": ["balanced"], "max_iter": [1000]}
    scaled = rows.withColumn("b", F.col("b") * 100 + 7)
    found = tuning.grid_search(scaled, "logistic_regression", grid, FEATURES, folds=3, metric="roc_auc")
    assert calls == [found.best_params]
    ((stored, tasks, (columns, points)),) = fits
    pdf = stored.toPandas()
    for i, (task, (candidate, fold)) in enumerate(zip(tasks, [(c, f) for c in tuning.grid(grid) for f in range(3)], strict=True)):
        part = pdf[pdf.fold != fold]
        x, y = part[FEATURES].to_numpy(), part["churned"].to_numpy()
        w = points[i, :-1] / columns.scale
        b = points[i, -1] - (w * columns.mean).sum()
        weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        slope = (x * (weight * (1 / (1 + np.exp(-(x @ w + b))) - y))[:, None]).mean(axis=0)
        reg = 1 / (candidate["C"] * len(y))
        assert task.reg == pytest.approx(reg) and task.fold == fold
        if candidate["penalty"] == "l2":
            assert np.abs(slope + reg * w) / columns.scale == pytest.approx(0, abs=1e-4)
        else:
            short = np.where(w == 0, np.maximum(np.abs(slope) - reg, 0), slope + reg * np.sign(w))
            assert np.abs(short) / columns.scale == pytest.approx(0, abs=1e-4)
        # MLlib, one by one, comes to the same scores.
        alone = models.fit(stored.where(F.col("fold") != fold), "logistic_regression", candidate, FEATURES)
        mllib = alone.pipeline.stages[-1]
        assert [*mllib.coefficients, mllib.intercept] == pytest.approx([*w, b], rel=0.02, abs=0.01)


def test_the_passes_of_linear_run_where_the_package_is_not(rows, tmp_path):
    """An executor has only what travels with the plan."""
    tasks = [linear.Task(0, (1.0, 1.0), 1.0, 0.1, 0.0, 5)]
    sent = cloudpickle.dumps((linear._sums(linear.Columns(rows, FEATURES), tasks, np.zeros((1, 4))), linear._added))
    code = (
        "import sys, pyarrow as pa\nfrom pyspark import cloudpickle\n"
        "sums, added = cloudpickle.loads(sys.stdin.buffer.read())\n"
        "batch = pa.record_batch({n: [1.0] for n in ('x0', 'x1', 'x2', 'label')} | {'fold': [1]})\n"
        "print(added(pa.Table.from_batches(list(sums(iter([batch]))))).num_rows)"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=sent, cwd=tmp_path, env=env, capture_output=True, timeout=60)
    assert done.stdout.split() == [b"1"], done.stderr.decode()


def test_search_where_a_training_part_lacks_a_class(rows):
    """Such parts are fitted one by one, as before."""
    few = rows.where("churned = 0").limit(20).unionByName(rows.where("churned = 1").limit(1))
    found = tuning.grid_search(few, "logistic_regression", {"C": [1.0], "max_iter": [5]}, FEATURES, folds=2)
    assert len(found.scores) == 1


def test_random_search_over_mixed_estimators(rows):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", models.IgnoredParameter)
        found = tuning.random_search(rows, "decision_tree", tuning.SPACES["decision_tree"], FEATURES, n=4, folds=2)
    assert len(found.scores) == 4
    assert found.best_score > 0.7


@pytest.mark.parametrize("kind", ["decision_tree", "xgboost"])
def test_a_search_of_trees_shares_its_rows(rows, monkeypatch, kind):
    """Vectors are assembled once, equal candidates are fitted once, and scores and model are those of fits one by one."""
    space = [SMALL[kind], {**SMALL[kind], "max_depth": 3}, {**SMALL[kind], "min_samples_split": 9}]  # the last is the first for MLlib
    if kind == "decision_tree":
        space += [{"max_depth": 4, "max_features": "sqrt"}, {"max_depth": 4, "criterion": "entropy"}]
    once, fits = tuning.fit_assembled, []
    monkeypatch.setattr(tuning, "fit", lambda *x, **y: pytest.fail("a fit of its own"))
    monkeypatch.setattr(tuning, "fit_assembled", lambda *x: fits.append(x[1]) or once(*x))
    with warnings.catch_warnings():
        warnings.simplefilter("ignore", models.IgnoredParameter)
        found = tuning.search(rows, kind, space, FEATURES, folds=3)
        assert len(fits) == 3 * (len(space) - 1) + 1
        stored = dataset.stratified_folds(rows, 3).cache()
        evaluator = tuning._evaluator("accuracy", "churned")
        for candidate, score in zip(found.candidates, found.scores, strict=True):
            parts = []
            for fold in range(3):
                alone = models.fit(stored.where(F.col("fold") != fold), kind, candidate, FEATURES)
                parts.append(evaluator.evaluate(alone.pipeline.transform(stored.where(F.col("fold") == fold))))
            assert score == pytest.approx(np.mean(parts), abs=1e-9)
        alone = models.fit(rows, kind, found.best_params, FEATURES)
    a, b = ({r.userId: r.score for r in m.predict(rows).collect()} for m in (found.best, alone))
    assert a == pytest.approx(b, abs=1e-9)
    assert found.best.inputs == tuple(FEATURES) and found.best.importance().count() == 3


def test_a_search_of_trees_where_a_training_part_lacks_a_class(rows):
    few = rows.where("churned = 0").limit(20).unionByName(rows.where("churned = 1").limit(1))
    found = tuning.search(few, "decision_tree", [{"max_depth": 2}], FEATURES, folds=2)
    assert len(found.scores) == 1


@pytest.fixture(scope="module")
def wide(spark):
    """In one partition, where sums of weights are those of MLlib to the last bit: few values, so that many splits are equally good."""
    rng = np.random.default_rng(1)
    x = np.hstack([rng.normal(size=(700, 6)), rng.integers(0, 5, size=(700, 5)), np.full((700, 1), 3)])
    y = (x[:, 0] + x[:, 7] + rng.normal(size=700) > 3).astype(int)
    names = [f"f{i}" for i in range(12)]
    pdf = pd.DataFrame(x, columns=names).assign(churned=y, userId=np.arange(700), obs_date=pd.Timestamp("2018-10-15"))
    return spark.createDataFrame(pdf).withColumn("obs_date", F.col("obs_date").cast("timestamp_ntz")).coalesce(1).cache(), names


MIXED = [
    {"max_depth": 30, "class_weight": "balanced"},
    {"max_depth": 6, "criterion": "entropy", "min_samples_leaf": 4},
    {"max_depth": 30, "max_features": "sqrt", "criterion": "entropy", "class_weight": "balanced"},
    {"max_depth": 12, "max_features": "log2", "min_samples_leaf": 2},
    {"max_depth": 3, "max_features": "sqrt", "min_samples_leaf": 40, "class_weight": "balanced"},
    {"max_depth": 30, "min_samples_leaf": 400},
]


@pytest.mark.parametrize("memory", [256, 0])
def test_a_grown_tree_is_that_of_mllib(wide, monkeypatch, memory):
    """Node by node as row by row, whatever is worked on at once, and in whatever order MLlib draws columns."""
    rows, names = wide
    monkeypatch.setattr(trees, "KEPT_ROWS", 8)
    monkeypatch.setattr(trees, "NODES", 3)
    monkeypatch.setattr(trees, "CHUNK", 500)
    monkeypatch.setattr(trees, "MLLIB_MEMORY", memory << 20)
    vectors = models.assembler(names)[0].transform(rows)
    pdf = rows.toPandas()
    y = pdf["churned"].to_numpy()
    for params in [p for p in MIXED if memory or p["max_depth"] < 30]:
        mapped = models.map_params("decision_tree", params)
        weights = linear.class_weights(mapped.weight, int((y == 0).sum()), int(y.sum()))
        weighted = vectors.withColumn("weight", F.when(F.col("churned") == 1, weights[1]).otherwise(weights[0]))
        splits = trees.thresholds(weighted, "churned", "weight", 42)
        codes = np.stack([2 * np.searchsorted(s, pdf[c]) + y for s, c in zip(splits, names, strict=True)], axis=1).astype(np.uint8)
        grower = trees._Grower(codes, np.arange(700), weights, [len(s) for s in splits], 42)
        grown = grower.grow(trees.tree_of(mapped.estimator, mapped.params, len(names)))
        model = mapped.build(label="churned").setMaxMemoryInMB(memory).fit(weighted)
        told = [r.prediction for r in model.transform(weighted).orderBy("userId").collect()]
        assert trees._predicted(codes, np.arange(700), grown).astype(float).tolist() == told, params


def test_many_single_trees_are_grown_together(wide, monkeypatch):
    """More of them than are fitted at once: MLlib fits the best only, and the scores are its own."""
    rows, names = wide
    once, fits = tuning.fit_assembled, []
    monkeypatch.setattr(tuning, "fit_assembled", lambda *x: fits.append(x[1]) or once(*x))
    found = tuning.search(rows, "decision_tree", MIXED, names, folds=3)
    assert 3 * len(MIXED) > tuning.MOST_FITS and len(fits) == 1
    monkeypatch.setattr(trees, "TASK_BYTES", len(names) * 700 - 1)  # rows that no task can hold are left to MLlib
    alone = tuning.search(rows, "decision_tree", MIXED, names, folds=3)
    assert len(fits) == 3 * len(MIXED) + 2
    assert found.candidates == alone.candidates and found.scores == alone.scores
    monkeypatch.setattr(trees, "TASK_BYTES", len(names) * 700)
    monkeypatch.setattr(trees, "MOST_BINS", 4)  # as are columns whose bins are too many for a byte
    again = tuning.search(rows, "decision_tree", MIXED, names, folds=3)
    assert len(fits) == 6 * len(MIXED) + 3 and again.scores == alone.scores


def test_only_single_trees_are_grown_together():
    for kind, params in [("xgboost", {}), ("random_forest", {"n_estimators": 1, "bootstrap": False}), ("decision_tree", {"max_features": "0.5"})]:
        mapped = models.map_params(kind, params)
        assert trees.tree_of(mapped.estimator, mapped.params, 9) is None
    mapped = models.map_params("decision_tree", {"max_features": "log2", "max_depth": 4, "min_samples_leaf": 3})
    assert trees.tree_of(mapped.estimator, mapped.params, 9) == trees.Tree(False, 4, 3, 4, True)


def test_trees_grow_where_the_package_is_not(tmp_path):
    """An executor has only what travels with the plan."""
    tree = trees.Tree(False, 2, 1, 1, False)
    parts = [trees.Part(0, ((5, tree),), (1.0, 1.0), (np.array([0.5]),))]
    sent = cloudpickle.dumps((trees._coded(parts, 1), trees._grown(parts, 4, 1, 42)))
    code = (
        "import sys, pyarrow as pa\nfrom pyspark import cloudpickle\n"
        "coded, grown = cloudpickle.loads(sys.stdin.buffer.read())\n"
        "batch = pa.record_batch({'x0': [0.0, 1.0, 0.0, 1.0], 'label': [0, 1, 0, 1], 'fold': [0, 0, 1, 1]})\n"
        "print([b.to_pylist() for b in grown(coded(iter([batch])))])"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], input=sent, cwd=tmp_path, env=env, capture_output=True, timeout=60)
    assert done.stdout.decode().strip() == "[[{'candidate': 5, 'fold': 0, 'hits': 2, 'n': 2}]]", done.stderr.decode()


def test_params_round_trip(spark, tmp_path):
    params = {"depth": 6, "learning_rate": 0.05, "penalty": None, "bootstrap": False, "name": "x"}
    sinks.write_params(spark, params, str(tmp_path / "params"))
    assert sinks.read_params(spark, str(tmp_path / "params")) == params


def test_registered_searches_and_fits_have_the_stated_sizes(spark, sf_dir, monkeypatch):
    from catalog import queries as registered
    from churn_engine.schema import FEATURES_V2

    class Seen(Exception):
        pass

    def seen(*args, **options):
        raise Seen(args, options)

    monkeypatch.setattr(tuning, "search", seen)
    monkeypatch.setattr(models, "fit", seen)
    monkeypatch.setattr(models, "fit_all", seen)

    def asked(name):
        with pytest.raises(Seen) as found:
            registered.queries()[name](spark, sf_dir)
        return found.value.args

    (_, kind, candidates, features), options = asked("grid_search")
    assert (kind, len(candidates), options["folds"], features) == ("logistic_regression", 8, 5, FEATURES_V2)
    assert {c["max_iter"] for c in candidates} == {1000}
    (_, kind, candidates, features), options = asked("random_search")
    assert (kind, len(candidates), options["folds"], features) == ("decision_tree", 50, 5, FEATURES_V2)
    (_, kind, params, features), _ = asked("catboost")
    assert (kind, params["iterations"], features) == ("catboost", 500, FEATURES_V2)
    (_, params, features), _ = asked("trained_model_comparison")
    assert set(params) == set(models.BASE_PARAMS) and len(params) == 5 and features == FEATURES_V2


def test_six_models_in_one_comparison(rows, fitted):
    best = metrics.compare_models(models.predictions(fitted, rows)).collect()
    assert {r.model for r in best} == set(models.KINDS) and sum(r.is_best for r in best) == 1


def test_neural_network(rows, fitted):
    model = fitted["neural_network"]
    assert model.pipeline.stages[-1].getLayers() == [3, 4, 2]
    with pytest.raises(ValueError):
        model.importance()
    with pytest.warns(models.IgnoredParameter, match="class_weight"):
        models.map_params("neural_network", {"class_weight": "balanced"})


def test_scaled_fit_uses_the_moments_of_its_rows(rows):
    wide = rows.withColumn("a", F.col("a") * 1000 + 5).withColumn("b", F.lit(7.0))
    model = models.fit(wide, "logistic_regression", {"C": 1.0}, FEATURES, scale=True)
    scaler = model.pipeline.stages[-2]
    stats = wide.agg(F.avg("a"), F.stddev_samp("a")).first()
    assert (scaler.mean[0], scaler.std[0], scaler.std[1]) == (pytest.approx(stats[0]), pytest.approx(stats[1]), 0.0)
    plain = models.fit(rows.withColumn("b", F.lit(7.0)), "logistic_regression", {"C": 1.0}, FEATURES, scale=True)
    a = {r.userId: r.score for r in model.predict(wide).collect()}
    b = {r.userId: r.score for r in plain.predict(rows.withColumn("b", F.lit(7.0))).collect()}
    assert a == pytest.approx(b, abs=1e-6)


def test_moments_are_fitted_once(rows, spark):
    table = rows.withColumns({"same": F.lit(3.0), "none": F.lit(None).cast("double")})
    train, other = table.where("userId < 200"), table.where("userId >= 200")
    moments = scaling.fit_moments(train, ["a", "same", "none"])
    assert sorted(scaling.Moments.of_table(moments.table(spark)).columns) == ["a", "none", "same"]
    stats = train.agg(F.avg("a").alias("m"), F.stddev_samp("a").alias("s")).first()
    plain = {r.userId: r.a for r in other.collect()}
    for r in scaling.scaled(other, moments).collect():
        assert (r.a, r.same, r.none) == (pytest.approx((plain[r.userId] - stats.m) / stats.s), 0.0, None)
    assert scaling.fit_moments(train.limit(0), ["a"]) == scaling.Moments(("a",), (0.0,), (0.0,))


def test_one_hot(spark):
    train = spark.createDataFrame([("Home", 1), ("Add Friend", 1), ("Home", None), (None, 2), ("add friend!", 2)], "page string, level int")
    known = encoding.fit_dictionary(train, ["page", "level"])
    assert known.values == {"page": ("Home", "Add Friend", "add friend!"), "level": ("1", "2")}
    assert known.names("page") == ["page_home", "page_add_friend", "page_add_friend_2"]
    assert encoding.Dictionary.of_table(known.table(spark)) == encoding.Dictionary(dict(sorted(known.values.items())))
    other = spark.createDataFrame([("Home", 2), ("New", None), (None, 9)], "page string, level int")
    names = [*known.names("page"), *known.names("level")]
    assert [tuple(r) for r in encoding.one_hot(other, known).select(*names).collect()] == [(1, 0, 0, 0, 1), (0,) * 5, (0,) * 5]
    own = encoding.one_hot(other, known, unseen="column").select("page_other", "level_other").collect()
    assert [tuple(r) for r in own] == [(0, 0), (1, 0), (0, 1)]
    with pytest.raises(Exception, match="no such value"):
        encoding.one_hot(other, known, unseen="error").collect()
    with pytest.raises(ValueError, match="more than 2"):
        encoding.fit_dictionary(train, ["page"], most=2)


def test_categories_travel_with_the_model(rows, spark, tmp_path):
    coded = rows.withColumn("page", F.when(F.col("churned") == 1, "bye").when(F.col("b") > 0, "home").otherwise("song"))
    known = encoding.fit_dictionary(coded, ["page"])
    model = models.fit(coded, "decision_tree", {"max_depth": 3}, ["b", "c"], categories=known)
    assert model.inputs == ("b", "c", *known.names("page"))
    assert model.importance().orderBy(F.desc("importance")).first().feature == "page_bye"
    unseen = coded.withColumn("page", F.lit("new"))
    assert model.predict(unseen).columns == [*unseen.columns, "prediction", "score"]
    model.save(str(tmp_path / "model"))
    again = models.FittedModel(model.name, model.kind, model.features, PipelineModel.load(str(tmp_path / "model")), model.inputs)
    assert sorted(r.score for r in again.predict(unseen).collect()) == sorted(r.score for r in model.predict(unseen).collect())


def test_experiment(rows):
    params = {"decision_tree": SMALL["decision_tree"], "random_forest": SMALL["random_forest"]}
    fitted, scored, compared = experiment(rows, params, FEATURES, {"random_forest": 0.9, "decision_tree": None, "xgboost": 0.1})
    assert list(fitted) == list(params) and scored.columns == ["model", "seq", "userId", "obs_date", "label", "prediction", "score"]
    train, test = dataset.train_test_split(rows)
    assert scored.count() == 2 * test.count()
    found = {r.model: r for r in compared.collect()}
    assert set(found) == {"decision_tree", "random_forest", "random_forest@0.9"} and sum(r.is_best for r in found.values()) == 1
    forest = scored.where("model = 'random_forest'").collect()
    assert found["random_forest"].accuracy == pytest.approx(np.mean([r.prediction == r.label for r in forest]))
    assert found["random_forest@0.9"].accuracy == pytest.approx(np.mean([int(r.score > 0.9) == r.label for r in forest]))
    assert found["random_forest"].auc == pytest.approx(found["random_forest@0.9"].auc) and found["random_forest"].auc > 0.85


def test_experiment_without_oversampling_or_thresholds(rows):
    _, _, compared = experiment(rows, {"decision_tree": SMALL["decision_tree"]}, FEATURES, oversample=False)
    assert [r.model for r in compared.collect()] == ["decision_tree"]
