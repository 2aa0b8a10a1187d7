"""Every registered query against its DuckDB oracle at sf0.001 (the driver uses sf0.01)."""

from __future__ import annotations

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry
from cinepulse.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
NAMES = sorted(QUERIES)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["events", "part"]:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_oracle():
    assert set(NAMES) <= set(entry.queries())
    assert set(NAMES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["window_start", "window_end", "movie_id", "genre", "views", "likes", "avg_rating", "engagement_score"]
    assert len(df.collect()) == 20


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(_norm(r[c]) for c in cols) for r in df.collect()), key=_key)
    rel = con.sql(entry.oracle_sql()[name])
    idx = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    want = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=_key)
    assert cols == sorted(rel.columns)
    assert got == want
    assert not any(isinstance(x, float) and math.isnan(x) for r in got for x in r)
