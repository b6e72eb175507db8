"""The generic ``events`` table seen as a raw event log (test input; rules in FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churn_engine.functions.timeexpr import floor_div


def item_in_session(log: DataFrame) -> DataFrame:
    """0-based position of an event in its session, ordered by (ts, event_id).

    Counts per minute of a session give the offset of that minute; only the events of one minute are
    sorted together, so a session of any length is spread over tasks.
    """
    session = ["userId", "sessionId"]
    log = log.withColumn("_minute", F.expr(floor_div("ts_us", 60_000_000)))
    earlier = Window.partitionBy(*session).orderBy("_minute").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        log.groupBy(*session, "_minute")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*session, "_minute", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy(*session, "_minute").orderBy("ts_us", "event_id")
    return log.join(offsets, [*session, "_minute"]).withColumn(
        "itemInSession", F.col("_before") + F.row_number().over(inside) - 1
    )


def events_as_log(spark: SparkSession, sf_dir: str, with_item: bool = True) -> DataFrame:
    """Raw log from ``events.parquet``. ``with_item=False`` leaves itemInSession 0 for callers that
    order by time only."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = F.get_json_object("props", "$.k").cast("int")
    epoch = F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'")
    # Every event counts; those of some users in two weeks move back in time, so that there are users without
    # recent activity.
    moved = (
        (F.col("user_id") % 10 == 9)
        & (F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-05 00:00:00'"))
        & (F.col("ts") < F.expr("TIMESTAMP_NTZ '2024-01-20 00:00:00'"))
    )
    kept = events.withColumn("ts", F.when(moved, F.expr("ts - INTERVAL 20 DAYS")).otherwise(F.col("ts"))).select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        "ts",
        k.alias("k"),
        F.timestamp_diff("MICROSECOND", epoch, F.col("ts")).alias("ts_us"),
    )
    late = F.col("ts") >= F.expr("TIMESTAMP_NTZ '2024-01-12 08:00:00'")
    group = F.col("user_id") % 4
    paid = (group == 1) | ((group == 2) & late) | ((group == 3) & ~late)
    kind, kk = F.col("event_type"), F.col("k")

    def bands(*steps: tuple[int, str], last: str):
        page = None
        for limit, name in steps:
            page = F.when(kk < limit, name) if page is None else page.when(kk < limit, name)
        return page.otherwise(last)

    page = (
        F.when(kind.isin("purchase", "click"), "NextSong")
        .when(kind == "view", bands((25, "Thumbs Up"), (50, "Add to Playlist"), (75, "Home"), (90, "Roll Advert"), last="Login"))
        .when(kind == "error", bands((30, "Help"), (45, "Error"), (70, "Settings"), (85, "Thumbs Down"), last="Logout"))
        .when(
            kind == "signup",
            bands(
                (25, "Add Friend"),
                (40, "About"),
                (55, "Downgrade"),
                (65, "Submit Downgrade"),
                (80, "Upgrade"),
                (88, "Submit Upgrade"),
                (97, "Cancel"),
                last="Cancellation Confirmation",
            ),
        )
    )
    song = kind.isin("purchase", "click")
    log = kept.select(
        "event_id",
        "ts_us",
        F.when((kind == "view") & (kk >= 97), "").otherwise(F.col("user_id").cast("string")).alias("userId"),
        (F.col("user_id") * 1000 + F.expr(f"pmod({floor_div('ts_us', 18_000_000_000)}, 1000)")).alias("sessionId"),
        F.expr(floor_div("ts_us", 1000)).alias("ts"),
        F.expr("TIMESTAMP_NTZ '2023-06-01 09:30:00' + make_dt_interval(CAST(user_id % 200 AS INT))").alias("registration"),
        F.when(F.col("user_id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.when(kk == 50, None).when(paid, "paid").otherwise("free").alias("level"),
        page.alias("page"),
        F.when(song, F.concat(F.lit("artist_"), (kk % 20).cast("string"))).alias("artist"),
        F.when(song, F.concat(F.lit("song_"), kk.cast("string"))).alias("song"),
        F.when(song, F.col("value")).alias("length"),
    )
    log = item_in_session(log) if with_item else log.withColumn("itemInSession", F.lit(0).cast("bigint"))
    return log.select(
        "userId", "sessionId", "itemInSession", "ts", "registration", "gender", "level", "page", "artist", "song", "length"
    )
