"""Traps of the definitions, with hand-computed values."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F
from toy import AT, OBS, cleaned, event, song

from churn_engine.functions.timeexpr import days_between, to_millis
from churn_engine.operators.snapshots import Snapshots, date_grid, snapshot_events
from churn_engine.plans.features import features_v0, features_v1, features_v2
from churn_engine.schema import CARRIED, FEATURES_V0, FEATURES_V1, FEATURES_V2, KEYS


def one(spark, rows, snapshots=AT, build=features_v2):
    (row,) = build(cleaned(spark, rows), snapshots).collect()
    return row


@pytest.mark.parametrize("ts, days", [("2018-10-14 12:00", 0), ("2018-10-15 06:00", -1), ("2018-10-08", 7)])
def test_days_are_elapsed_not_calendar(spark, ts, days):
    assert spark.range(1).select(F.expr(days_between(f"{to_millis(OBS)}L", f"{to_millis(ts)}L"))).first()[0] == days


def test_sizes_and_names():
    assert (len(FEATURES_V0), len(FEATURES_V1), len(FEATURES_V2)) == (12, 42, 65)


@pytest.mark.parametrize("build, names", [(features_v0, FEATURES_V0), (features_v1, FEATURES_V1), (features_v2, FEATURES_V2)])
def test_columns_and_no_nulls(spark, build, names):
    df = build(cleaned(spark, [event("2018-10-14", registration=None, gender=None, level=None)]), AT)
    assert df.columns == [*KEYS, *names, *CARRIED]
    row = df.first()
    assert all(row[n] is not None for n in names)
    assert row.registration is None


def test_unknown_counts_stay_unknown_until_the_end(spark):
    row = one(spark, [event("2018-10-14", "Thumbs Up", item=i) for i in range(3)] + [event("2018-10-14", "Add to Playlist", item=3)])
    assert row.thumbs_up_count == 3
    assert (row.friends_added, row.has_social_activity, row.positive_actions, row.satisfaction_ratio) == (0, 0, 0, 0)


def test_no_recent_event_is_not_a_decline(spark):
    row = one(spark, [event("2018-10-05")])
    assert (row.songs_last_7_days, row.activity_decline) == (0, 0)
    assert row.churn_risk_score == 1  # inactive for more than 3 days; the unknown decline adds nothing


def test_risk_score_adds_up(spark):
    rows = [event("2018-10-10", p, item=i) for i, p in enumerate(["Cancel", "Help", "Help", "Help", "Thumbs Down"])]
    rows[0]["level"] = "paid"
    rows = [dict(r, ts=to_millis("2018-10-10") + i) for i, r in enumerate(rows)]
    assert one(spark, rows).churn_risk_score == 3 + 2 + 3 + 1 + 2 + 1


def test_first_and_last_level_skip_unknown(spark):
    levels = [None, "free", "paid", None]
    row = one(spark, [event(f"2018-10-0{i + 1}", level=v) for i, v in enumerate(levels)])
    assert (row.level_first, row.level_current) == (0, 1)


@pytest.mark.parametrize("levels, last", [([None, "free", "paid"], "2018-10-03"), (["free", None], "2018-10-02")])
def test_level_change(spark, levels, last):
    row = one(spark, [event(f"2018-10-0{i + 1}", level=v) for i, v in enumerate(levels)])
    assert row.days_on_current_level == (to_millis(OBS) - to_millis(last)) // 86_400_000


def test_level_never_changed_gives_membership(spark):
    row = one(spark, [event("2018-10-01")])
    assert row.days_on_current_level == row.membership_length == 68


def test_same_millisecond_is_ordered_by_item(spark):
    rows = [event("2018-10-01", item=1, level="paid"), event("2018-10-01", item=0, level="free")]
    row = one(spark, rows)
    assert (row.level_first, row.level_current) == (0, 1)


def test_order_holds_for_items_of_any_size(spark):
    rows = [event("2018-10-01", item=2_000_000, level="paid"), event("2018-10-01", item=3_000_000, level="free")]
    row = one(spark, rows)
    assert (row.level_first, row.level_current) == (1, 0)
    rows = [event("2018-10-01", item=2**62, level="paid"), event("2018-10-01", item=-(2**62), level="free")]
    row = one(spark, rows)
    assert (row.level_first, row.level_current) == (0, 1)


@pytest.mark.parametrize("asof", [False, True])
def test_a_time_in_microseconds_fails_no_job(spark, asof):
    rows = [song("2018-10-01", session=5), song("2018-10-02", title="t", session=2)]
    late = dict(song("2018-10-03", session=3), ts=to_millis("2018-10-03") * 1000)
    at = Snapshots.at(OBS, asof_sessions=asof)
    assert one(spark, [*rows, late], at) == one(spark, rows, at)


def test_all_null_values(spark):
    row = one(spark, [song("2018-10-14", artist=None, title=None, length=None)])
    assert (row.unique_artists, row.unique_songs, row.total_length, row.avg_song_length) == (0, 0, 0, 0)


def test_window_bounds(spark):
    rows = [song(ts, title=ts, session=i) for i, ts in enumerate(["2018-10-08", "2018-10-01", "2018-09-15", "2018-09-14 23:59:59.999"])]
    row = one(spark, rows)
    assert (row.songs_last_7_days, row.sessions_last_7_days) == (1, 1)
    assert (row.songs_historical, row.sessions_historical, row.artists_historical) == (1, 1, 1)
    assert row.num_songs_played == 4


def test_bounds_hold_for_every_date_of_a_grid(spark):
    grid = Snapshots.every("2018-10-15 06:00", "2018-10-25 06:00")
    rows = [song("2018-10-08 06:00"), song("2018-10-13 06:00", title="t"), song("2018-10-20 06:00", title="u")]
    got = {str(r.obs_date)[:10]: (r.songs_last_7_days, r.unique_songs) for r in features_v1(cleaned(spark, rows), grid).collect()}
    assert got == {"2018-10-15": (2, 2), "2018-10-20": (2, 3), "2018-10-25": (1, 3)}


def test_grid_ends_at_or_before_the_end():
    assert [str(d)[5:10] for d in date_grid("2018-10-15", "2018-11-05", 5)] == ["10-15", "10-20", "10-25", "10-30", "11-04"]


def test_mode_of_level(spark):
    rows = [event("2018-10-01", item=i, level=v) for i, v in enumerate(["paid", "free", "free", "paid"])]
    assert one(spark, rows, build=features_v0).level == 0
    assert one(spark, [event("2018-10-01", level=None)], build=features_v0).level == 0


def test_trend(spark):
    rows, session = [], 0
    for day, n in zip(("01", "03", "04", "09"), (1, 3, 2, 5), strict=True):
        for _ in range(n):
            session += 1
            rows += [event(f"2018-10-{day} 10:00", session=session), event(f"2018-10-{day} 11:00", session=session)]
    row = one(spark, rows)
    assert row.session_freq_trend == pytest.approx(1.1)
    assert row.session_consistency == pytest.approx(1.707825, abs=1e-6)
    row = one(spark, [event("2018-10-01"), event("2018-10-02", session=2), event("2018-10-02 05:00", session=3)])
    assert (row.session_freq_trend, row.session_consistency) == (0, 0)


def test_a_day_without_session_ids_is_an_active_day(spark):
    rows = [event(f"2018-10-0{i + 1}", session=s) for i, s in enumerate([1, None, 2, 3])]
    row = one(spark, rows)  # 1, 0, 1, 1
    assert (row.session_freq_trend, row.session_consistency) == (pytest.approx(0.1), pytest.approx(0.5))


def test_a_session_over_midnight_counts_on_both_days(spark):
    rows = [event("2018-10-01 23:59"), event("2018-10-02 00:01"), event("2018-10-02 09:00", session=2), event("2018-10-03", session=3)]
    assert one(spark, rows).session_freq_trend == pytest.approx(0.0)  # 1, 2, 1
    assert one(spark, rows).session_consistency == pytest.approx(math.sqrt(1 / 3))


def test_decay(spark):
    row = one(spark, [song("2018-10-15"), event("2018-10-08", session=2)])
    assert row.weighted_songs == pytest.approx(1 / (1 + math.exp(-1) + 1))
    assert row.weighted_sessions == pytest.approx(1 + math.exp(-1))


def test_session_length_leaks_unless_asked(spark):
    rows = [event("2018-10-14 23:59:50"), event("2018-10-15 00:00:10")]
    assert one(spark, rows).avg_session_length == 20.0
    assert one(spark, rows, Snapshots.at(OBS, asof_sessions=True)).avg_session_length == 0.0
    assert one(spark, rows, Snapshots.at(OBS, asof_sessions=True)).last_session_length == 0.0


def test_mean_session_length_is_weighted_by_events(spark):
    rows = [event("2018-10-01 00:00:00"), event("2018-10-01 00:00:05"), event("2018-10-01 00:00:10"), event("2018-10-02", session=2)]
    assert one(spark, rows).avg_session_length == pytest.approx(30 / 4)


def test_without_cutoff_later_events_count(spark):
    rows = [song("2018-10-01"), song("2018-10-16", title="t")]
    assert one(spark, rows).num_songs_played == 1
    row = one(spark, rows, Snapshots.at(OBS, cutoff=False))
    assert (row.num_songs_played, row.songs_last_7_days, row.days_since_last_activity) == (2, 1, -1)


def test_zero_denominator_without_cutoff(spark):
    row = one(spark, [song("2018-10-15 06:00")], Snapshots.at(OBS, cutoff=False))
    assert (row.days_active, row.songs_per_day_overall) == (-1, 0)


def random_log(seed: int, users: int = 6, events: int = 400) -> list[dict]:
    rng = random.Random(seed)
    pages = ["NextSong", "Help", "Cancel", "Thumbs Down", "Thumbs Up", "Downgrade", "Add Friend", "Home", "Cancellation Confirmation"]
    rows = []
    for i in range(events):
        user = rng.randrange(users) if rng.random() < 0.66 else 0  # user 0 holds over a third
        ts = f"2018-{rng.choice(['09', '10'])}-{rng.randrange(1, 31):02d} {rng.randrange(24):02d}:{rng.randrange(60):02d}"
        page = rng.choice(pages)
        more = {"artist": f"a{rng.randrange(9)}", "song": f"s{rng.randrange(30)}", "length": rng.random() * 300} if page == "NextSong" else {}
        rows.append(
            event(ts, page, user=str(user), session=user * 100 + rng.randrange(9), item=i, level=rng.choice(["free", "paid", None]), **more)
        )
    return rows


def table(df) -> dict:
    return {
        (r.userId, r.obs_date): tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()
    }


def test_row_order_and_partitioning_do_not_matter(spark):
    rows = random_log(1)
    grid = Snapshots.every("2018-10-01", "2018-10-20", 5)
    expected = table(features_v2(cleaned(spark, rows), grid))
    shuffled = cleaned(spark, random.Random(2).sample(rows, len(rows))).repartition(7)
    assert table(features_v2(shuffled, grid)) == expected


def test_later_events_do_not_change_a_snapshot(spark):
    rows = random_log(3)
    at = Snapshots.at(OBS, asof_sessions=True)
    before = [r for r in rows if r["ts"] <= to_millis(OBS)]
    assert table(features_v2(cleaned(spark, rows), at)) == table(features_v2(cleaned(spark, before), at))


def test_a_grid_equals_its_dates_one_by_one(spark):
    rows = random_log(4)
    days = [*date_grid("2018-09-20", "2018-10-20", 1), "2018-10-07 05:30"]  # and another time of day
    events = cleaned(spark, rows).cache()
    whole = table(features_v1(events, Snapshots(days)))
    for day in (days[0], days[17], days[-1]):
        single = table(features_v1(events, Snapshots.at(day)))
        assert single == {k: v for k, v in whole.items() if k in single}
    assert len({k[1] for k in whole}) == len(days)


@pytest.mark.parametrize("options", [{}, {"asof_sessions": True}, {"cutoff": False}])
def test_a_year_of_daily_dates_is_one_pass(spark, options):
    events = cleaned(spark, random_log(6)).cache()
    year = Snapshots.every("2018-03-01 07:15", "2019-02-28 07:15", 1, **options)
    assert len(year.dates) == 365 and len(list(year.passes())) == 1
    whole = table(features_v2(events, year))
    for day in (year.dates[i] for i in (190, 214, 215, 222, 240, 260, 364)):
        single = table(features_v2(events, Snapshots.at(day, **options)))
        assert single == {k: v for k, v in whole.items() if k[1] == day}


def test_scans_do_not_depend_on_the_number_of_dates(spark, tmp_path):
    cleaned(spark, random_log(7)).write.parquet(f"{tmp_path}/log")
    scans = []
    for grid in (Snapshots.every("2018-10-01", "2018-10-16", 5), Snapshots.every("2018-01-01", "2018-12-31", 1)):
        plan = features_v2(spark.read.parquet(f"{tmp_path}/log"), grid)._jdf.queryExecution().executedPlan().toString()
        scans.append(plan.count("FileScan parquet"))
    assert scans[0] == scans[1] == 3


def test_dates_with_gaps(spark):
    events = cleaned(spark, random_log(8)).cache()
    grid = Snapshots(["2018-09-03", "2018-09-04", "2018-09-30", "2018-10-01", "2018-10-29", "2018-12-25"])
    whole = table(features_v2(events, grid))
    for day in grid.dates:
        assert table(features_v2(events, Snapshots.at(day))) == {k: v for k, v in whole.items() if k[1] == day}


def test_only_grids_of_many_years_are_cut(spark):
    grid = Snapshots.every("2000-01-01", "2019-01-01", 365)
    assert [len(x.dates) for x in grid.passes()] == [12, 8]
    events = cleaned(spark, random_log(9)).cache()
    last = table(features_v2(events, Snapshots.at(grid.dates[-1])))
    assert last and last == {k: v for k, v in table(features_v2(events, grid)).items() if k[1] == grid.dates[-1]}


def test_fan_out_of_events(spark):
    grid = Snapshots.every("2018-10-15", "2018-10-25")
    rows = [event("2018-10-15"), event("2018-10-15 00:00:00.001", item=1), event("2018-10-26", item=2)]
    got = snapshot_events(cleaned(spark, rows), grid).groupBy("itemInSession").count().collect()
    assert {r[0]: r[1] for r in got} == {0: 3, 1: 2}


def test_plans_hold_no_cartesian_product_and_no_python(spark):
    plan = features_v2(cleaned(spark, random_log(5)), Snapshots.every("2018-10-01", "2018-10-20"))._jdf.queryExecution().executedPlan().toString()
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SortAggregate", "ObjectHashAggregate"):
        assert word not in plan
