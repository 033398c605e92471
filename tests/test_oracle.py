"""Every query with SQL gives the rows that DuckDB gives on the same tables."""

from __future__ import annotations

import pytest
from oracle_check import compare, connect

import __spark_entry__ as contract

SQL = contract.oracle_sql()
QUERIES = contract.queries()


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf, duck, name):
    assert compare(spark, duck, sf, QUERIES[name], SQL[name]) == ""


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
