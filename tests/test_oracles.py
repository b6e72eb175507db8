"""Every registered query that has SQL, against DuckDB on the same tables."""

from __future__ import annotations

import pytest
from compare import connect, differences

import __spark_entry__ as registry

ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_oracle_has_a_query():
    assert not set(ORACLES) - set(registry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert differences(registry.queries()[name](spark, sf_dir), con, ORACLES[name]) == []


def test_the_comparison_sees_differences(spark, sf_dir, con):
    df = registry.queries()["user_base"](spark, sf_dir)
    spoiled = ORACLES["user_base"].replace("sum(session_ms) / (count(*)", "1e-5 + sum(session_ms) / (count(*)")
    assert spoiled != ORACLES["user_base"]
    assert differences(df, con, spoiled)
    assert differences(df, con, ORACLES["user_base"] + " WHERE gender = 0")
