"""Queries against their SQL on the smallest test tables."""

import datetime
import os

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CORE = [n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline"]
SLOW = {"pagerank_10"}


def norm(v):
    if isinstance(v, float):
        return round(v, 6)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
@pytest.mark.parametrize("name", [n for n in CORE if n not in SLOW])
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    r = duck.execute(entry.oracle_sql()[name])
    names = [x[0] for x in r.description]
    at = sorted(range(len(names)), key=lambda i: names[i])
    assert sorted(names) == cols
    assert got == sorted((tuple(norm(x[i]) for i in at) for x in r.fetchall()), key=repr)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
