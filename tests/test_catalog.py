"""Every named query against its SQL."""

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry_points
from tickspan.catalog import QUERIES, SQL


@pytest.fixture(scope="module")
def db(data):
    return connect(data)


def test_every_query_has_its_sql():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_sql(spark, data, db, name):
    found, wanted = spark_rows(QUERIES[name](spark, data)), sql_rows(db, SQL[name])
    assert found[0] == wanted[0]
    assert found[1] == wanted[1]
    assert found[1]


def test_entry(spark):
    assert entry_points.entry(spark).count() >= 0
