"""Every text query with SQL against that SQL."""

import pytest

from checks import compare
from ledgerloom.llm.oracles import ORACLES
from ledgerloom.llm.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_check):
    connection = compare.connect(sf_check)
    yield connection
    connection.close()


def test_one_query_per_operator():
    assert {n.split("_")[0] for n in QUERIES if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, con, sf_check, name):
    columns, rows = compare.spark_rows(QUERIES[name](spark, sf_check))
    sql_columns, sql_rows = compare.sql_rows(con, ORACLES[name])
    assert columns == sql_columns
    assert rows == sql_rows
