"""Every registered query against its SQL on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from checks import compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for table in compare.BASES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    ok, note = compare.compare(spark, con, SF, name)
    assert ok is not False, note


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
