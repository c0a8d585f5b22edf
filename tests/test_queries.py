"""Every registered query with a SQL answer equals it on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return c


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=str)
    cur = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in order) for r in cur.fetchall()), key=str)
    assert got == want


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 150 and "customer_risk_score" in df.columns


def test_every_query_is_callable():
    assert len(entry.queries()) > 140 and set(entry.oracle_sql()) <= set(entry.queries())
