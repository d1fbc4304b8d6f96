"""Every registered query with SQL against DuckDB at the smallest scale."""

import duckdb
import pytest

from paneflow.oracles import ORACLES
from paneflow.workload import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("events", "customer")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    return connection


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_its_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF)
    columns = sorted(frame.columns)
    got = sorted((tuple(_plain(r[c]) for c in columns) for r in frame.collect()), key=repr)
    answer = duck.sql(ORACLES[name])
    assert sorted(answer.columns) == columns
    places = [answer.columns.index(c) for c in columns]
    want = sorted((tuple(_plain(r[i]) for i in places) for r in answer.fetchall()), key=repr)
    assert got == want
