"""The registered queries: each runs one operator of the engine over the whole ``events`` table, seen
as a raw log."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churn_engine.ml import models, tuning
from churn_engine.operators import correlation, dataset, derived, encoding, labels, metrics, profile, scaling, smote
from churn_engine.operators.activity import activity
from churn_engine.operators.clean import CLEAN_COLUMNS, clean_events, with_session_length
from churn_engine.operators.session_activity import session_activity, session_trend
from churn_engine.operators.snapshots import Snapshots, snapshot_events
from churn_engine.plans.experiment import experiment
from churn_engine.plans.features import features_v0, features_v1, features_v2, unfilled_v2
from churn_engine.plans.training import scoring_set, training_set
from churn_engine.schema import FEATURES_V1, FEATURES_V2, KEYS, LABEL, PAGE_COUNTS, PAGE_SET_COUNTS
from churn_engine.session import materialise
from churn_engine.sources.events_view import events_as_log
from churn_engine.sources.logs import read_log
from churn_engine.sources.sinks import submission

TRAINING = Snapshots.every("2024-01-05", "2024-01-20", 5)
SCORING_DATE = "2024-01-25"
THRESHOLDS = [0.0001, 0.005, 0.015, 0.12, 0.45, 0.47, 0.5, 0.54]
RULE_THRESHOLDS = {"risk_rule": 0.47, "inactivity": 0.12, "help_share": 0.015}

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame) -> DataFrame:
    """Doubles to 6 places for comparison: half up, with slack far above the noise of a sum taken in
    another order, so that exact ties round the same way on every engine. Never gives -0.0."""
    short = {c: F.floor(F.col(c) * 1e6 + 0.5001) / 1e6 for c, t in df.dtypes if t == "double"}
    return df.withColumns(short) if short else df


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(read_log(spark, events_as_log(spark, sf_dir)))


def _on_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(build(events(spark, sf_dir)))


def _labels(ev: DataFrame) -> DataFrame:
    return labels.labels(ev, TRAINING)


def _rules(ev: DataFrame) -> DataFrame:
    """Three scores that need no training, as a long table of predictions."""
    rows = training_set(ev, TRAINING)
    scores = {
        "risk_rule": F.col("churn_risk_score") / F.lit(float(derived.RiskWeights().maximum)),
        "inactivity": F.least(F.col("days_since_last_activity"), F.lit(30)) / F.lit(30.0),
        "help_share": F.col("help_visits") / (F.col("total_page_views") + F.lit(1.0)),
    }
    stacked = F.array(
        *[
            F.struct(
                F.lit(name).alias("model"),
                F.lit(i).alias("seq"),
                score.cast("double").alias("score"),
                metrics.threshold_class(score, RULE_THRESHOLDS[name]).alias("prediction"),
            )
            for i, (name, score) in enumerate(scores.items())
        ]
    )
    return rows.select(*KEYS, F.col(LABEL).alias("label"), F.inline(stacked))


def _unfilled(*names: str) -> Query:
    return _on_events(lambda ev: unfilled_v2(ev, TRAINING).select(*KEYS, *names))


def _activity(*names: str) -> Query:
    return _on_events(lambda ev: activity(ev, TRAINING).select(*KEYS, *names))


def _weights(ev: DataFrame) -> DataFrame:
    both = dataset.with_class_weight(_labels(ev), "balanced", name="balanced")
    return dataset.with_class_weight(both, "positive", name="positive")


def _roc_curve(ev: DataFrame) -> DataFrame:
    """All points; the infinite threshold of the starting point is shown as NULL."""
    points = metrics.roc_curve(_rules(ev))
    return points.withColumn("threshold", F.when(F.col("threshold") < float("inf"), F.col("threshold")))


def _submission(ev: DataFrame, *names: str) -> DataFrame:
    day = F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'")
    return submission(_rules(ev).where((F.col("model") == "risk_rule") & (F.col("obs_date") == day)), *names)


PROFILED = ["userId", "sessionId", "itemInSession", "ts", "registration", "gender", "level", "page", "artist", "song", "length", "song_played"]
CATEGORIES = ["page", "gender", "level", "artist", "song", "registration", "userId"]


def _column_profile(ev: DataFrame) -> DataFrame:
    """What is exact in the profile."""
    return profile.profile(ev, PROFILED).select("column", "n_rows", "nulls", "least", "greatest", "mean")


def _model(kind: str) -> Query:
    """Train on the hash split's training part, score its test part."""
    params = models.BASE_PARAMS[kind]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = materialise(training_set(events(spark, sf_dir), TRAINING))
        train, test = dataset.train_test_split(rows)
        fitted = models.fit(train, kind, params, FEATURES_V2)
        return rounded(models.predictions({kind: fitted}, test))

    return run


def _trained_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(training_set(events(spark, sf_dir), TRAINING))
    train, test = dataset.train_test_split(rows)
    fitted = models.fit_all(train, models.BASE_PARAMS, FEATURES_V2)
    return rounded(metrics.compare_models(materialise(models.predictions(fitted, test))))


def _scaled(ev: DataFrame) -> DataFrame:
    """Test rows, scaled by the moments of the training rows."""
    train, test = dataset.train_test_split(materialise(rounded(training_set(ev, TRAINING))))
    return scaling.scaled(test.select(*KEYS, *FEATURES_V2), scaling.fit_moments(train, FEATURES_V2))


def _page_positions(ev: DataFrame) -> DataFrame:
    """Where the page of each event stands in the dictionary of the log's first two days."""
    known = encoding.fit_dictionary(ev.where(F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-03 00:00:00'")), ["page", "level"])
    coded = encoding.one_hot(ev, known, unseen="column")
    ones = sum(F.col(c) for c in [*known.names("page"), "page_other"])
    names = [encoding.position(known, c).alias(f"{c}_position") for c in ("page", "level")]
    return coded.select("userId", "sessionId", "itemInSession", "page", *names, "page_other", "level_other", ones.alias("page_ones"))


def _neural_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train the multilayer perceptron on the hash split's training part, score its test part."""
    train, test = dataset.train_test_split(materialise(training_set(events(spark, sf_dir), TRAINING)))
    fitted = models.fit(train, "neural_network", features=FEATURES_V2)
    return rounded(models.predictions({"neural_network": fitted}, test))


def _experiment(params: dict, thresholds: dict, *kinds: str) -> Query:
    """Split, oversample the training part, fit the named models, compare them at their own class and at their thresholds."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = training_set(events(spark, sf_dir), TRAINING)
        return rounded(experiment(rows, {k: params[k] for k in kinds}, FEATURES_V2, thresholds)[2])

    return run


def _scored_submission(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = events(spark, sf_dir)
    fitted = models.fit(
        materialise(training_set(ev, TRAINING)), "random_forest", features=FEATURES_V2
    )
    threshold = models.BASE_THRESHOLDS["random_forest"]
    return submission(fitted.predict(scoring_set(ev, SCORING_DATE), threshold))


def _importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = materialise(training_set(events(spark, sf_dir), TRAINING))
    return rounded(models.fit(rows, "decision_tree", features=FEATURES_V2).importance())


def _grid_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_set(events(spark, sf_dir), TRAINING)
    return tuning.grid_search(rows, "logistic_regression", tuning.LR_GRID, FEATURES_V2, folds=5, metric="roc_auc").table()


def _random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = training_set(events(spark, sf_dir), TRAINING)
    return tuning.random_search(rows, "decision_tree", tuning.SPACES["decision_tree"], FEATURES_V2, n=50, folds=5).table()


def queries() -> dict[str, Query]:
    raw: Query = lambda spark, sf_dir: read_log(spark, events_as_log(spark, sf_dir))
    return {
        "raw_log": raw,
        "clean_events": _on_events(lambda ev: ev.select(*CLEAN_COLUMNS)),
        "session_length": _on_events(lambda ev: with_session_length(ev).select("userId", "sessionId", "ts", "session_length")),
        "snapshot_fanout": _on_events(
            lambda ev: snapshot_events(ev, TRAINING).select("userId", "sessionId", "ts", "page", "obs_date")
        ),
        "column_profile": _on_events(_column_profile),
        "top_values": _on_events(lambda ev: profile.top_values(ev, CATEGORIES)),
        "category_profile": _on_events(
            lambda ev: profile.category_profile(ev, CATEGORIES).withColumn("samples", F.array_join("samples", "|"))
        ),
        "correlation_matrix": _on_events(lambda ev: correlation.correlation_matrix(materialise(rounded(training_set(ev, TRAINING))), [LABEL, *FEATURES_V2])),
        "label_correlation": _on_events(lambda ev: correlation.correlation_with(materialise(rounded(training_set(ev, TRAINING))), LABEL, FEATURES_V2)),
        "churned_users": _on_events(lambda ev: labels.churned_users(ev, "2024-01-10", "2024-01-20")),
        "churned_by_date": _on_events(lambda ev: labels.churned_by_date(ev, TRAINING)),
        "labels": _on_events(_labels),
        "labels_without_churned": _on_events(lambda ev: labels.labels(ev, TRAINING, exclude_churned=True)),
        "snapshot_report": _on_events(lambda ev: labels.snapshot_report(_labels(ev))),
        "user_base": _on_events(lambda ev: features_v1(ev, TRAINING).select(*KEYS, *FEATURES_V1[:12])),
        "recent_activity": _unfilled(
            "songs_last_7_days", "sessions_last_7_days", "artists_last_7_days", "avg_session_length_recent"
        ),
        "historical_activity": _unfilled("songs_historical", "sessions_historical", "artists_historical"),
        "page_counts": _activity(*PAGE_COUNTS),
        "up_downgrade_attempts": _activity(*PAGE_SET_COUNTS),
        "recent_page_counts": _activity("cancel_visits_recent", "help_visits_recent", "thumbs_down_recent"),
        "days_since_events": _on_events(
            lambda ev: derived.days_since(derived.tenure(activity(ev, TRAINING))).select(
                *KEYS, "days_since_cancel_visit", "days_since_help_visit", "days_since_downgrade_attempt"
            )
        ),
        "level_change": _unfilled("level_first", "level_current", "downgraded", "days_on_current_level"),
        "session_trend": _on_events(lambda ev: session_trend(ev, TRAINING)),
        "decay_engagement": _on_events(
            lambda ev: activity(ev, TRAINING)
            .join(session_activity(ev, TRAINING), KEYS, "left")
            .select(*KEYS, "weighted_songs", "weighted_sessions")
        ),
        "last_session": _on_events(lambda ev: session_activity(ev, TRAINING).select(*KEYS, "last_session_length")),
        "derived_ratios": _unfilled(
            "songs_per_day_overall",
            "songs_per_day_recent",
            "activity_decline",
            "songs_per_session",
            "artist_diversity",
            "positive_actions",
            "satisfaction_ratio",
            "engagement_rate",
            "problem_signals",
            "ads_per_song",
            "actions_per_session",
            "recent_vs_historical_songs",
            "recent_vs_historical_sessions",
            "recent_vs_historical_artists",
            "session_length_decline",
            "artist_exploration_rate",
        ),
        "risk_score": _on_events(lambda ev: features_v2(ev, TRAINING).select(*KEYS, "churn_risk_score")),
        "features_v0": _on_events(lambda ev: features_v0(ev, TRAINING)),
        "features_v1": _on_events(lambda ev: features_v1(ev, TRAINING)),
        "features_v2": _on_events(lambda ev: features_v2(ev, TRAINING)),
        "features_v2_asof_sessions": _on_events(
            lambda ev: features_v2(ev, Snapshots.every("2024-01-05", "2024-01-20", 5, asof_sessions=True))
        ),
        "training_set_v1": _on_events(lambda ev: training_set(ev, TRAINING, "v1")),
        "training_set": _on_events(lambda ev: training_set(ev, TRAINING)),
        "scoring_set": _on_events(lambda ev: scoring_set(ev, SCORING_DATE)),
        "scoring_set_no_cutoff": _on_events(lambda ev: scoring_set(ev, SCORING_DATE, cutoff=False)),
        "class_weights": _on_events(lambda ev: dataset.class_counts(_labels(ev))),
        "row_weights": _on_events(_weights),
        "hash_split": _on_events(lambda ev: dataset.hash_split(_labels(ev))),
        "stratified_folds": _on_events(lambda ev: dataset.stratified_folds(_labels(ev))),
        "plain_folds": _on_events(lambda ev: dataset.stratified_folds(_labels(ev), k=3, label=None)),
        "user_folds": _on_events(lambda ev: dataset.user_folds(_labels(ev))),
        "scaled_features": _on_events(_scaled),
        "page_one_hot": _on_events(_page_positions),
        "smote_neighbours": _on_events(
            lambda ev: smote.smote_neighbours(materialise(rounded(training_set(ev, TRAINING))), FEATURES_V2)
        ),
        "smote_resample": _on_events(lambda ev: smote.smote_resample(rounded(training_set(ev, TRAINING)), FEATURES_V2)),
        "smote_resample_zero": _on_events(
            lambda ev: smote.smote_resample(
                rounded(training_set(ev, TRAINING)).withColumn(LABEL, F.lit(1) - F.col(LABEL)), FEATURES_V2
            )
        ),
        "confusion_matrix": _on_events(lambda ev: metrics.confusion_matrix(_rules(ev))),
        "classification_report": _on_events(lambda ev: metrics.classification_report(_rules(ev))),
        "model_metrics": _on_events(lambda ev: metrics.model_metrics(_rules(ev))),
        "roc_curve": _on_events(_roc_curve),
        "roc_auc": _on_events(lambda ev: metrics.roc_auc(_rules(ev))),
        "predicted_rate": _on_events(lambda ev: metrics.predicted_rate(_rules(ev))),
        "threshold_score": _on_events(lambda ev: _rules(ev).select("model", *KEYS, "score", "prediction")),
        "submission": _on_events(_submission),
        "submission_renamed": _on_events(lambda ev: _submission(ev, "userId", "prediction")),
        "threshold_sweep": _on_events(lambda ev: metrics.threshold_sweep(_rules(ev), THRESHOLDS)),
        "model_comparison": _on_events(lambda ev: metrics.compare_models(_rules(ev))),
        "best_model": _on_events(lambda ev: metrics.best_model(_rules(ev))),
        "logistic_regression": _model("logistic_regression"),
        "decision_tree": _model("decision_tree"),
        "random_forest": _model("random_forest"),
        "xgboost": _model("xgboost"),
        "catboost": _model("catboost"),
        "neural_network": _neural_network,
        "oversampled_comparison": _experiment(models.BASE_PARAMS, models.BASE_THRESHOLDS, "logistic_regression", "decision_tree", "random_forest"),
        "tuned_logistic_regression": _experiment(models.TUNED_PARAMS, models.TUNED_THRESHOLDS, "logistic_regression"),
        "tuned_decision_tree": _experiment(models.TUNED_PARAMS, models.TUNED_THRESHOLDS, "decision_tree"),
        "trained_model_comparison": _trained_comparison,
        "scored_submission": _scored_submission,
        "feature_importance": _importance,
        "grid_search": _grid_search,
        "random_search": _random_search,
    }
