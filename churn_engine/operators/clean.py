"""Cleaning the raw log and measuring sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churn_engine.functions.exprs import code
from churn_engine.functions.timeexpr import timestamp_of
from churn_engine.schema import GENDER_CODES, LEVEL_CODES, SONG_PAGE

CLEAN_COLUMNS = [
    "userId",
    "sessionId",
    "itemInSession",
    "ts",
    "registration",
    "gender",
    "level",
    "page",
    "artist",
    "song",
    "length",
    "song_played",
]


def clean_events(raw: DataFrame) -> DataFrame:
    """Typed events of logged-in users.

    ``ts_ms`` is the raw epoch column itself, so a time filter on it reaches the Parquet scan; all
    later time arithmetic uses it.
    """
    if "ts" in raw.columns and dict(raw.dtypes)["ts"] != "bigint":
        raise ValueError("clean_events takes the raw log (ts in epoch milliseconds), not a cleaned one")
    user = F.expr("try_cast(userId AS BIGINT)")
    return raw.where((F.col("userId") != "") & user.isNotNull()).select(
        user.alias("userId"),
        "sessionId",
        "itemInSession",
        F.expr(timestamp_of("ts")).alias("ts"),
        F.col("ts").alias("ts_ms"),
        F.col("registration").cast("timestamp_ntz").alias("registration"),
        code("gender", GENDER_CODES).alias("gender"),
        code("level", LEVEL_CODES).alias("level"),
        "page",
        "artist",
        "song",
        F.nanvl(F.col("length"), F.lit(None).cast("double")).alias("length"),
        F.coalesce(F.col("page") == SONG_PAGE, F.lit(False)).cast("int").alias("song_played"),
    )


def rejected_events(raw: DataFrame) -> DataFrame:
    """Rows with an id that is neither blank nor a number; cleaning leaves them out."""
    return raw.where((F.col("userId") != "") & F.expr("try_cast(userId AS BIGINT)").isNull())


def session_lengths(events: DataFrame) -> DataFrame:
    """Seconds from the first to the last event of each (userId, sessionId)."""
    return events.groupBy("userId", "sessionId").agg(
        ((F.max("ts_ms") - F.min("ts_ms")) / F.lit(1000.0)).alias("session_length")
    )


def with_session_length(events: DataFrame) -> DataFrame:
    """Put the session's duration on each of its events.

    A grouped aggregate and an equi-join instead of a window: the aggregate combines on the map side,
    and AQE can split the event side of the join when one session holds much of the log, which no
    window partition allows. A null session id stays without a length.
    """
    return events.join(session_lengths(events.where(F.col("sessionId").isNotNull())), ["userId", "sessionId"], "left")
