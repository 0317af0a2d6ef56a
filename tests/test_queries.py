"""Every named query with a SQL twin gives DuckDB's rows on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

FOLDER = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return (0, "")
    if isinstance(value, (bool, str)):
        return (1, str(value))
    try:
        return (2, float(value))
    except (TypeError, ValueError):
        return (1, str(value))


def rows(records):
    return sorted(tuple(plain(v) for v in r) for r in records)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = queries()[name](spark, str(FOLDER))
    names = sorted(df.columns)
    relation = duck.sql(oracle_sql()[name])
    assert sorted(relation.columns) == names
    wanted = ", ".join(f'"{c}"' for c in names)
    expected = duck.execute(f"SELECT {wanted} FROM ({oracle_sql()[name]})").fetchall()
    assert rows(df.select(*[f"`{c}`" for c in names]).collect()) == rows(expected)


def test_entry(spark):
    assert entry(spark).count() > 0


def test_plain_queries_are_rows_only():
    assert set(oracle_sql()) < set(queries())
