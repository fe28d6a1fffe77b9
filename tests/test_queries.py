"""Every named query against its SQL, over the smallest tables."""

import pytest
from oracle import SMALL, connect, differences

import __spark_entry__ as entry_points

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(QUERIES[name](spark, SMALL), duck, ORACLES[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry(spark):
    assert {r["status"] for r in entry_points.entry(spark).collect()} == {"valid", "schema_invalid", "no_json"}


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
