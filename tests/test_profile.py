"""Profiles and correlations on planted tables."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from churn_engine.operators import correlation, profile

KIND = "day int, id long, page string, value double, empty string"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    pages = [None if p == "p9" else p for p in rng.choice([f"p{i}" for i in range(10)], 4000, p=np.arange(10, 0, -1) / 55)]
    values = [None if i % 11 == 0 else float(v) for i, v in enumerate(rng.normal(size=4000))]
    return [(i % 7, i, p, v, None) for i, (p, v) in enumerate(zip(pages, values, strict=True))]


@pytest.fixture(scope="module")
def table(spark, rows):
    return spark.createDataFrame(rows, KIND)


def checked(found, rows) -> None:
    by = {r["column"]: r for r in found}
    for at, name in enumerate(["day", "id", "page", "value", "empty"]):
        there = [r[at] for r in rows if r[at] is not None]
        one = by[name]
        assert (one.n_rows, one.nulls) == (len(rows), len(rows) - len(there))
        assert one.least == (str(min(there)) if there else None) and one.greatest == (str(max(there)) if there else None)
        assert abs(one.distinct - len(set(there))) <= 0.06 * len(set(there))
        if there and not isinstance(there[0], str):
            assert one["mean"] == pytest.approx(sum(there) / len(there))
            ranks = [np.mean(np.array(there) <= q) for q in one.quantiles]
            assert np.allclose(ranks, profile.QUANTILES, atol=0.15 if name == "day" else 0.02)
        else:
            assert one["mean"] is None and one.quantiles is None


def test_profile(table, rows):
    checked(profile.profile(table.repartition(5)).collect(), rows)


def test_sketches_of_parts_merge(table, rows):
    daily = profile.column_sketches(table, by=["day"])
    assert daily.count() == 7
    merged = profile.read_sketches(profile.merge_sketches(daily)).collect()
    checked([*merged, *[r for r in profile.profile(table, ["day"]).collect()]], rows)
    one = {r.day: r for r in profile.profile(table, ["id"], by=["day"]).collect()}
    assert [int(one[d].least) for d in range(7)] == list(range(7))


def test_profile_of_an_empty_table(spark):
    empty = spark.createDataFrame([], KIND)
    assert {(r["column"], r.n_rows, r.nulls, r.least, r.distinct, r.quantiles) for r in profile.profile(empty).collect()} == {
        (c, 0, 0, None, 0, None) for c in ("day", "id", "page", "value", "empty")
    }
    assert profile.top_values(empty, ["page", "id"]).count() == 0
    assert profile.category_profile(empty, ["page"]).count() == 0


@pytest.mark.parametrize("tracked", [16, 1024])
def test_top_values_are_exact(table, rows, tracked):
    """Also where the sketch cannot tell, as for ids that occur once each."""
    found = {(r["column"], r["rank"]): (r.value, r.n) for r in profile.top_values(table.repartition(6), ["page", "id", "value", "empty", "day"], 4, tracked).collect()}
    for at, name in enumerate(["day", "id", "page", "value"]):
        counts = Counter(r[at] for r in rows if r[at] is not None)
        if name == "value":
            assert all(n == 1 for (c, _), (_, n) in found.items() if c == name)
            continue
        best = sorted(((-n, str(v)) for v, n in counts.items()))[:4]
        assert [found[name, i + 1] for i in range(4)] == [(v, -n) for n, v in best]
    assert not any(c == "empty" for c, _ in found)


def test_category_profile(table, rows):
    found = {r["column"]: r for r in profile.category_profile(table, ["page", "day", "empty"], samples=3).collect()}
    assert (found["page"]["values"], found["day"]["values"], "empty" in found) == (9, 7, False)
    assert len(found["page"].samples) == 3 and set(found["page"].samples) < {r[2] for r in rows}
    assert found["page"].n == sum(r[2] is not None for r in rows)


def test_correlations_equal_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3000, 4)) @ rng.normal(size=(4, 4)) + 1e6
    holes = rng.random(x.shape) < 0.1
    data = [(*[None if h else (float("nan") if i % 97 == 0 else float(v)) for v, h in zip(a, b, strict=True)], 0.1, i % 2) for i, (a, b) in enumerate(zip(x, holes, strict=True))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, same double, label int").repartition(7)
    names = ["a", "b", "c", "d", "same", "label"]
    found = {(r.a, r.b): r for r in correlation.correlation_matrix(df, names).collect()}
    assert len(found) == 15
    plain = np.array([[np.nan if v is None else v for v in row] for row in data])
    for i, a in enumerate(names):
        for j in range(i + 1, 6):
            both = np.isfinite(plain[:, i]) & np.isfinite(plain[:, j])
            r = found[a, names[j]]
            assert r.n == both.sum()
            if "same" in (a, names[j]):
                assert r.correlation is None
            else:
                assert r.correlation == pytest.approx(np.corrcoef(plain[both, i], plain[both, j])[0, 1], abs=1e-9)
    with_label = {r.feature: r.correlation for r in correlation.correlation_with(df, "label", names).collect()}
    assert set(with_label) == set(names) - {"label"} and with_label["a"] == pytest.approx(found["a", "label"].correlation)
    assert correlation.correlation_matrix(df.limit(0), ["a", "b"]).where(F.col("correlation").isNotNull()).count() == 0
