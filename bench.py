"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

The raw log is written to Parquet first (its time is in the sum and also reported apart), because a stored log is what the
engine reads in use. Every query then runs from that log to its full result: one warm-up, and the
median of three runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame  # noqa: E402

from catalog.queries import SCORING_DATE, THRESHOLDS, TRAINING, _rules  # noqa: E402
from churn_engine.ml import models  # noqa: E402
from churn_engine.operators import dataset, labels, metrics, smote  # noqa: E402
from churn_engine.operators.clean import clean_events, with_session_length  # noqa: E402
from churn_engine.operators.snapshots import snapshot_events  # noqa: E402
from churn_engine.plans.features import features_v0, features_v1, features_v2  # noqa: E402
from churn_engine.plans.training import scoring_set, training_set  # noqa: E402
from churn_engine.schema import FEATURES_V2  # noqa: E402
from churn_engine.session import build_session, materialise  # noqa: E402
from churn_engine.sources.events_view import events_as_log  # noqa: E402
from churn_engine.sources.logs import read_log  # noqa: E402

RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def seconds(work: Callable[[], DataFrame | None]) -> float:
    start = time.perf_counter()
    df = work()
    if df is not None:
        df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    path = tempfile.mkdtemp(prefix="run-bench-") + "/log"
    prepare = seconds(lambda: events_as_log(spark, sf_dir).write.parquet(path))

    def events() -> DataFrame:
        return clean_events(read_log(spark, path))

    rows = materialise(training_set(events(), TRAINING))
    queries: dict[str, Callable[[], DataFrame | None]] = {
        "clean_events": events,
        "session_length": lambda: with_session_length(events()),
        "snapshot_fanout": lambda: snapshot_events(events(), TRAINING),
        "labels": lambda: labels.labels(events(), TRAINING),
        "snapshot_report": lambda: labels.snapshot_report(labels.labels(events(), TRAINING)),
        "features_v0": lambda: features_v0(events(), TRAINING),
        "features_v1": lambda: features_v1(events(), TRAINING),
        "features_v2": lambda: features_v2(events(), TRAINING),
        "training_set": lambda: training_set(events(), TRAINING),
        "scoring_set": lambda: scoring_set(events(), SCORING_DATE),
        "stratified_folds": lambda: dataset.stratified_folds(labels.labels(events(), TRAINING)),
        "roc_auc": lambda: metrics.roc_auc(_rules(events())),
        "threshold_sweep": lambda: metrics.threshold_sweep(_rules(events()), THRESHOLDS),
        "model_comparison": lambda: metrics.compare_models(_rules(events())),
        "smote_neighbours": lambda: smote.smote_neighbours(materialise(training_set(events(), TRAINING)), FEATURES_V2),
        "smote_resample": lambda: smote.smote_resample(training_set(events(), TRAINING), FEATURES_V2),
        "logistic_regression_fit": lambda: models.fit(rows, "logistic_regression", features=FEATURES_V2) and None,
        "decision_tree_fit": lambda: models.fit(rows, "decision_tree", features=FEATURES_V2) and None,
    }
    chosen = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else list(queries)
    timings = {}
    for name in chosen:
        seconds(queries[name])
        timings[name] = round(statistics.median(seconds(queries[name]) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "seconds to prepare the log and sum of median seconds per query",
                "value": round(prepare + sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "prepare_log": round(prepare, 3),
                "events": events().count(),
                "cpus": int(cpus),
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
