"""Every registered query against its SQL at sf0.001 (the driver checks sf0.01)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cadenza.plans.oracles import ORACLE_SQL
from cadenza.plans.queries import QUERIES
from cadenza.sources.tables import TABLES
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return con


def _norm(v):
    if isinstance(v, float):
        return round(v, 4)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _canon(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in data), key=repr)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "spotify_artist_name" in df.columns and "ingestion_date" in df.columns


def test_every_query_has_sql_or_is_documented():
    missing = set(QUERIES) - set(ORACLE_SQL)
    assert not missing


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_matches_sql(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    assert _canon(df.columns, got) == _canon(cols, want)
    assert not any(isinstance(v, float) and math.isnan(v) for r in got for v in r)
