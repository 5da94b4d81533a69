"""The registered queries against the same SQL in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.oracle import connect, difference
from workload.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("key", QUERIES)
def test_query_equals_sql(spark, connection, key):
    wrong, rows = difference(spark, connection, QUERIES[key], ORACLE_SQL[key], FOLDER)
    assert wrong is None and rows > 0


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLE_SQL.keys()
    assert QUERIES.keys() <= driver.queries().keys() and driver.oracle_sql().keys() <= driver.queries().keys()


def test_entry(spark):
    got = driver.entry(spark)
    assert got.columns == ["event_type", "count"] and got.count() == 3
