"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry_points
from checks import compare, oracles, queries

QUERIES = queries.registered()
ORACLES = oracles.registered()


@pytest.fixture(scope="module")
def con(sf_check):
    connection = compare.connect(sf_check)
    yield connection
    connection.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_matches_sql(spark, con, sf_check, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_check))
    sql_columns, sql_rows = compare.sql_rows(con, ORACLES[name])
    assert columns == sql_columns
    assert len(rows) == len(sql_rows)
    assert len(rows) > 0
    assert rows == sql_rows


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.count() > 0
