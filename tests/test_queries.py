from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry
from quire.queries import QUERIES, SQL


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(round(r[i], 6) if isinstance(r[i], float) else str(r[i]) for i in order).__repr__() for r in data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    db = duckdb.connect()
    for f in os.listdir(sf_dir):
        db.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{f}'")
    want = db.sql(SQL[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert rows(df.columns, got) == rows(want.columns, want.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
