"""Session settings and lineage cuts."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "churn_engine", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans count on; ``conf`` wins over them.

    On a cluster leave ``master`` unset and size ``spark.sql.shuffle.partitions`` for the log
    (AQE coalesces what is too fine), e.g. two to four times the number of cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.requireAllClusterKeysForCoPartition": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # A feature set has more generated classes than the default of 100; with fewer, none is ever found again.
        "spark.sql.codegen.cache.maxEntries": "1000",
        "spark.ui.enabled": "false",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def materialise(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so lost executors do not replay the whole log.

    Uses the folder of ``spark.checkpoint.dir``. Where that is unset, a local session gets a scratch
    folder; on a cluster a shared folder is required.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="churn-checkpoint-")
        context.setCheckpointDir(folder)
    return df.checkpoint()
