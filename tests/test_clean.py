from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from toy import AT, cleaned, event, raw, song

from churn_engine.operators.clean import CLEAN_COLUMNS, clean_events, rejected_events, with_session_length
from churn_engine.sources.logs import LogSchemaError, read_log, read_train_test, validate_log


def test_blank_null_and_bad_ids(spark):
    log = raw(spark, [event("2018-10-01", user=u) for u in ("", None, "3", "x7")])
    assert [r.userId for r in clean_events(log).collect()] == [3]
    assert [r.userId for r in rejected_events(log).collect()] == ["x7"]


def test_codes_times_and_song_flag(spark):
    rows = [
        event("2018-10-01 00:01:57.123", gender="M", level="paid"),
        song("2018-10-01 00:02:00", gender="X", level=None, length=float("nan")),
    ]
    first, second = cleaned(spark, rows).orderBy("ts_ms").collect()
    assert (first.gender, first.level, first.song_played) == (1, 1, 0)
    assert first.ts == datetime(2018, 10, 1, 0, 1, 57, 123000)
    assert (second.gender, second.level, second.song_played, second.length) == (None, None, 1, None)


def test_times_do_not_depend_on_the_session_zone(spark):
    log = raw(spark, [event("2018-10-28 02:30:00.5")])
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
        assert clean_events(log).first().ts == datetime(2018, 10, 28, 2, 30, 0, 500000)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_cleaning_twice_is_refused(spark):
    with pytest.raises(ValueError, match="raw log"):
        clean_events(cleaned(spark, [event("2018-10-01")]))


def test_session_length_in_fractional_seconds(spark):
    rows = [event("2018-10-01 00:00:00.500"), event("2018-10-01 00:00:02.000"), event("2018-10-01", session=None)]
    got = {r.sessionId: r.session_length for r in with_session_length(cleaned(spark, rows)).collect()}
    assert got == {1: 1.5, None: None}


def test_validation_names_what_is_wrong(spark):
    log = raw(spark, [event("2018-10-01")])
    with pytest.raises(LogSchemaError, match="missing columns: page"):
        validate_log(log.drop("page"))
    with pytest.raises(LogSchemaError, match="ts is string, expected bigint"):
        validate_log(log.withColumn("ts", F.lit("x")))


def test_wider_input_types_are_accepted(spark):
    log = raw(spark, [event("2018-10-01")])
    other = log.withColumns(
        {
            "userId": F.col("userId").cast("int"),
            "sessionId": F.col("sessionId").cast("int"),
            "registration": F.lit("2018-08-08 13:22:21"),
            "length": F.lit(1.5).cast("float"),
            "firstName": F.lit("unused"),
        }
    )
    got = read_log(spark, other)
    assert got.schema == log.schema or got.columns == log.columns
    assert got.first().registration == datetime(2018, 8, 8, 13, 22, 21)
    instant = log.withColumn("registration", F.timestamp_seconds(F.lit(1533734541)))
    assert read_log(spark, instant).first().registration == datetime(2018, 8, 8, 13, 22, 21)


def test_parquet_scan_is_pruned_and_filtered(spark, tmp_path):
    raw(spark, [event("2018-10-01"), event("2018-11-01")]).write.parquet(str(tmp_path / "log"))
    train, test = read_train_test(spark, str(tmp_path / "log"), str(tmp_path / "log"))
    assert train.schema == test.schema
    counted = AT.up_to_last_date(clean_events(train)).groupBy("page").count()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(ts,1539561600000)" in plan
    assert "ReadSchema: struct<userId:string,ts:bigint,page:string>" in plan
    assert counted.collect()[0]["count"] == 1


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_log(spark, str(tmp_path / "nothing"))


def test_clean_columns(spark):
    assert set(CLEAN_COLUMNS) == set(cleaned(spark, [event("2018-10-01")]).columns) - {"ts_ms"}
