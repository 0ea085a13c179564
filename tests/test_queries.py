"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    ok, text = compare(spark, name, QUERIES[name], SQL.get(name), FOLDER, con)
    assert ok, text


def test_sql_keys_are_queries():
    assert set(SQL) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1
