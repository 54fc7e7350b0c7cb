"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as spark_entry
from ledgerlens.registry.queries import QUERIES
from tools.check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert len(df.columns) == 38 and df.count() == 1000


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = spark_entry.queries()[name](spark, SF)
    sql = spark_entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        assert compare(df, con, sql) == ""
