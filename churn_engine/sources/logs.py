"""Reading the raw event log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churn_engine.schema import RAW_LOG


class LogSchemaError(ValueError):
    """The input lacks a column of the log, or has it with another type."""


# Types that hold the same values without loss, and how they become the type of the schema.
_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_ACCEPTED: dict[str, tuple[type, ...]] = {
    "userId": (T.StringType, *_INTEGERS),
    "sessionId": _INTEGERS,
    "itemInSession": _INTEGERS,
    "ts": (T.LongType,),
    "registration": (T.TimestampNTZType, T.TimestampType, T.DateType, T.StringType),
    "length": (T.DoubleType, T.FloatType, T.DecimalType, *_INTEGERS),
}


def _as_schema_type(name: str, found: T.DataType, wanted: T.DataType) -> Column:
    if found == wanted:
        return F.col(name)
    if isinstance(found, T.TimestampType):  # an instant: its UTC wall time, whatever the session zone
        return F.expr(f"timestampadd(MICROSECOND, unix_micros({name}), TIMESTAMP_NTZ '1970-01-01 00:00:00')").alias(name)
    return F.col(name).cast(wanted).alias(name)


def validate_log(df: DataFrame) -> DataFrame:
    """Check names and types against the log schema; returns the frame cut to those columns."""
    found = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in RAW_LOG.fields if f.name not in found]
    if missing:
        raise LogSchemaError(f"missing columns: {', '.join(missing)}")
    wrong = [
        f"{f.name} is {found[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in RAW_LOG.fields
        if not isinstance(found[f.name], _ACCEPTED.get(f.name, (type(f.dataType),)))
    ]
    if wrong:
        raise LogSchemaError("; ".join(wrong))
    return df.select(*[_as_schema_type(f.name, found[f.name], f.dataType) for f in RAW_LOG.fields])


def read_log(spark: SparkSession, data: str | DataFrame) -> DataFrame:
    """A Parquet log by path, or a frame passed through; either way validated, other columns dropped.

    A missing path raises when the plan is built. The file's own schema is read (one footer), so that
    a wrong type is an error here and not a silent NULL later.
    """
    return validate_log(spark.read.parquet(data) if isinstance(data, str) else data)


def read_train_test(spark: SparkSession, train: str | DataFrame, test: str | DataFrame) -> tuple[DataFrame, DataFrame]:
    """Training and test log, same schema."""
    return read_log(spark, train), read_log(spark, test)
