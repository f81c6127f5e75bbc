"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import rows_of
from orderlayers.queries.registry import QUERIES

FOLDER = "/root/testdata/sf0.001"
ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return connection


def test_every_sql_has_a_query():
    assert set(QUERIES) <= set(ORACLE) <= set(entry.queries())


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, duck, name):
    frame = entry.queries()[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert rows_of(frame.collect(), frame.columns) == rows_of(cursor.fetchall(), columns)


def test_entry(spark):
    counts = {row["record_status"]: row["row_count"] for row in entry.entry(spark).collect()}
    assert sum(counts.values()) == 1500 and counts["Corrected"] == 749
