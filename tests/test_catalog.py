"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest
from check_oracle import TABLES, rows_of

import __spark_entry__ as entry
from regflow.catalog import oracle
from regflow.catalog.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


def test_both_sides_have_the_same_names():
    assert set(QUERIES) == set(oracle.oracle_sql())
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, database, name):
    frame = entry.queries()[name](spark, SF)
    result = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    got = rows_of(frame.columns, frame.collect())
    assert got == rows_of(columns, result.fetchall())
    assert got


def test_entry(spark):
    assert entry.entry(spark).limit(1).count() == 1
