from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F
from test_features import random_log
from toy import AT, OBS, cleaned, event

from churn_engine.operators import labels
from churn_engine.operators.snapshots import Snapshots
from churn_engine.plans.training import scoring_set, training_set
from churn_engine.schema import FEATURES_V1, KEYS, LABEL

CANCEL = "Cancellation Confirmation"


def test_label_window_is_open_then_closed(spark):
    stamps = {"1": OBS, "2": "2018-10-15 00:00:00.001", "3": "2018-10-25", "4": "2018-10-25 00:00:00.001"}
    rows = [event("2018-10-01", user=u) for u in stamps] + [event(ts, CANCEL, user=u) for u, ts in stamps.items()]
    got = {r.userId: r.churned for r in labels.labels(cleaned(spark, rows), AT).collect()}
    assert got == {1: 0, 2: 1, 3: 1, 4: 0}
    users = labels.churned_users(cleaned(spark, rows), OBS, "2018-10-25")
    assert sorted(r.userId for r in users.collect()) == [2, 3]


def test_earlier_cancellations_stay_or_go(spark):
    rows = [event("2018-10-01", CANCEL), event("2018-10-02", user="2")]
    ev = cleaned(spark, rows)
    assert {(r.userId, r.churned) for r in labels.labels(ev, AT).collect()} == {(1, 0), (2, 0)}
    assert [r.userId for r in labels.labels(ev, AT, exclude_churned=True).collect()] == [2]


def test_one_cancellation_labels_two_snapshots(spark):
    rows = [event("2018-10-01"), event("2018-10-22", CANCEL)]
    grid = Snapshots.every("2018-10-10", "2018-10-25")
    got = {str(r.obs_date)[:10]: r.churned for r in labels.labels(cleaned(spark, rows), grid).collect()}
    assert got == {"2018-10-10": 0, "2018-10-15": 1, "2018-10-20": 1, "2018-10-25": 0}


def test_user_seen_only_after_the_date_is_not_labelled(spark):
    assert labels.labels(cleaned(spark, [event("2018-10-16", CANCEL)]), AT).count() == 0


def test_report(spark):
    rows = [event("2018-10-01"), event("2018-10-20", CANCEL), event("2018-10-01", user="2")]
    (row,) = labels.snapshot_report(labels.labels(cleaned(spark, rows), AT)).collect()
    assert (row.obs_date, row.users, row.churn_rate) == (datetime(2018, 10, 15), 2, 0.5)


def test_training_set_defaults_and_scoring_projection(spark):
    ev = cleaned(spark, random_log(7))
    rows = training_set(ev, version="v1")
    assert rows.columns == [*KEYS, *FEATURES_V1, LABEL]
    assert rows.select("obs_date").distinct().count() == 5
    assert scoring_set(ev, version="v1").columns == [*KEYS, *FEATURES_V1]


def test_features_and_label_see_different_events(spark):
    """Dropping the label window changes labels only; dropping the past changes no label."""
    ev = cleaned(spark, random_log(8))
    base = training_set(ev, AT, "v1").drop(LABEL)
    past = training_set(ev.where(F.col("ts") <= F.lit(datetime(2018, 10, 15))), Snapshots.at(OBS, asof_sessions=True), "v1")
    whole = training_set(ev, Snapshots.at(OBS, asof_sessions=True), "v1")
    assert whole.drop(LABEL).exceptAll(past.drop(LABEL)).count() == 0
    assert past.agg(F.sum(LABEL)).first()[0] == 0
    assert base.count() == whole.count()
