"""Training and scoring sets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame

from churn_engine.operators.dataset import project_features
from churn_engine.operators.labels import with_label, without_churned
from churn_engine.operators.snapshots import Snapshots
from churn_engine.plans.features import FEATURE_NAMES, FEATURE_SETS
from churn_engine.schema import KEYS, LABEL

# The dates of the original data.
DEFAULT_TRAINING_GRID = ("2018-10-15", "2018-11-05", 5)
DEFAULT_SCORING_DATE = "2018-11-20"


def training_set(
    events: DataFrame, snapshots: Snapshots | None = None, version: str = "v2", exclude_churned: bool = False
) -> DataFrame:
    """Stacked, labelled rows (userId, obs_date, features, churned) over the whole grid."""
    snapshots = snapshots or Snapshots.every(*DEFAULT_TRAINING_GRID)
    features = FEATURE_SETS[version](events, snapshots)
    rows = project_features(features, FEATURE_NAMES[version])
    if exclude_churned:
        rows = without_churned(rows, events)
    return with_label(rows, events, snapshots).select(*KEYS, *FEATURE_NAMES[version], LABEL)


def scoring_set(
    events: DataFrame, day: str | datetime = DEFAULT_SCORING_DATE, version: str = "v2", cutoff: bool = True
) -> DataFrame:
    """Unlabelled rows at one date, on the feature list of the training set."""
    features = FEATURE_SETS[version](events, Snapshots.at(day, cutoff=cutoff))
    return project_features(features, FEATURE_NAMES[version])
