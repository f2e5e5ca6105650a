"""Every registered query against its SQL on the small tables."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(data):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{data}/{table}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(plain(record[i]) for i in order)) for record in records)


@pytest.mark.parametrize("slug", sorted(ORACLES))
def test_matches_sql(spark, duck, data, slug):
    df = QUERIES[slug](spark, data)
    cursor = duck.execute(ORACLES[slug])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, cursor.fetchall())


@pytest.mark.parametrize("slug", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, data, slug):
    assert QUERIES[slug](spark, data).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
