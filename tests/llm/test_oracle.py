"""Queries that SQL can express, next to their SQL on the smallest tables."""

import duckdb
import pytest
from check_oracle import TABLES, rows_of

from regflow.llm.oracle import ORACLE_SQL
from regflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, database, name):
    frame = QUERIES[name](spark, SF)
    result = database.execute(ORACLE_SQL[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    got = rows_of(frame.columns, frame.collect())
    assert got == rows_of(columns, result.fetchall())
    assert got
