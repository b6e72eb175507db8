"""Writing submissions and parameters."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def submission(scored: DataFrame, id_name: str = "id", target_name: str = "target") -> DataFrame:
    """The two columns of a submission; the ids come from the scored rows themselves."""
    return scored.select(F.col("userId").alias(id_name), F.col("prediction").cast("int").alias(target_name))


def write_submission(
    scored: DataFrame, path: str, id_name: str = "id", target_name: str = "target", mode: str = "errorifexists"
) -> None:
    """Write the submission as CSV part files with a header, in parallel."""
    submission(scored, id_name, target_name).write.mode(mode).option("header", True).csv(path)


def write_params(spark: SparkSession, params: Mapping[str, Any], path: str, mode: str = "errorifexists") -> None:
    """Save chosen parameters as JSON rows ``name, value`` (values JSON-encoded)."""
    rows = [(name, json.dumps(value)) for name, value in params.items()]
    spark.createDataFrame(rows, "name string, value string").coalesce(1).write.mode(mode).json(path)


def read_params(spark: SparkSession, path: str) -> dict[str, Any]:
    """Read what :func:`write_params` wrote."""
    rows = spark.read.schema("name string, value string").json(path).collect()
    return {r["name"]: json.loads(r["value"]) for r in rows}
