"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest
from oracle import compare, oracle_connection

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    sql = entry.oracle_sql().get(name)
    if sql:
        assert compare(df, con, sql) == ""
    else:
        assert df.count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
