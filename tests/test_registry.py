"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as contract
from tests.oracle import connect, spark_rows, sql_rows


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query_agrees_with_sql(spark, sf_dir, db, name):
    frame = contract.queries()[name](spark, sf_dir)
    names, rows = spark_rows(frame)
    assert rows, "no rows: the comparison would be empty"
    sql = contract.oracle_sql().get(name)
    if sql is not None:
        assert (names, rows) == sql_rows(db, sql)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
