"""Every registered query against its SQL on the smallest tables."""

import oracle
import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()
FOLDER = oracle.folder("0.001")


@pytest.fixture(scope="module")
def con():
    return oracle.connection(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = oracle.compare(spark, con, FOLDER, QUERIES[name], SQL.get(name), name)
    assert ok, note


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["month", "brand", "revenue", "lines"]
    assert df.count() > 0


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
