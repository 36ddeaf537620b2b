"""Every registered query against its SQL."""

import pytest

import __spark_entry__ as entry
from tests.check import compare, duck


@pytest.fixture(scope="module")
def con(data):
    return duck(data)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, data, con, name):
    df = entry.queries()[name](spark, data)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.collect()
    else:
        assert compare(df, con, sql) is None


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["l_returnflag", "n", "avg_qty"]
    assert df.count() == 3


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
