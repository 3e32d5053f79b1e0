"""Every registered query against its SQL, on the smallest tables."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from verify import TABLES, compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("key", queries())
def test_query_equals_sql(spark, duck, key):
    frame = queries()[key](spark, SF)
    got = frame.collect()
    if key not in oracle_sql():
        assert got
        return
    result = duck.execute(oracle_sql()[key])
    names = [column[0] for column in result.description]
    assert compare(got, frame.columns, result.fetchall(), names) == ""


def test_entry(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
