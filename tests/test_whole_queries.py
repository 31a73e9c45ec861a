"""Queries over the whole job, without SQL, against brute force."""

import os
import re

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from loomgraph import queries
from loomgraph.plans import search

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def test_prompts_all(spark):
    want = {(r.conv_id, r.turn, f"Title: {r.role}\n\nContent: {r.text[:600]}") for r in spark.read.parquet(f"{DATA}/conversations.parquet").collect()}
    assert {tuple(r) for r in entry.queries()["prompts_all"](spark, DATA).collect()} == want
    assert max(len(p) for _, _, p in want) > 80


def decoded(t):
    def char(m, base):
        n = int(m[1], base)
        return chr(n) if 0 < n <= 0x10FFFF and not 0xD800 <= n <= 0xDFFF else m[0]

    t = re.sub("&#([0-9]{1,7});", lambda m: char(m, 10), t.replace("&#160;", " "))
    t = re.sub("&#[xX]([0-9a-fA-F]{1,6});", lambda m: char(m, 16), t)
    for name, c in (("amp", "&"), ("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'")):
        t = t.replace(f"&{name};", c)
    return re.sub("&[a-z]+;", " ", t)


def test_entity_decode_all(spark):
    got = {r.page_id: r.decoded for r in entry.queries()["entity_decode_all"](spark, DATA).collect()}
    assert got == {r.page_id: decoded(r.html) for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}


def test_spell_correct_all(spark):
    i = search.build(queries.corpus(spark, DATA))
    vocabulary = {r.word for r in i.vocabulary.select("word").collect()}
    known = vocabulary | {r.stem for r in i.stems.select("stem").collect()}
    odd = pd.DataFrame({"w": sorted(w for w in (v + "q" for v in vocabulary) if len(w) >= 4 and w not in known)})  # noqa: F841
    every = pd.DataFrame({"v": sorted(vocabulary)})  # noqa: F841
    found = duckdb.sql("select w, levenshtein(w, v) as d, v from odd, every where w[:2] = v[:2] and abs(len(w) - len(v)) <= 3 and levenshtein(w, v) <= 2").fetchall()
    want = {}
    for w, d, c in sorted(found, reverse=True):
        want[w] = (c, d)
    assert {r.word: (r.correction, r.distance) for r in entry.queries()["spell_correct_all"](spark, DATA).collect()} == want
    assert any(len(w) > 7 for w in want) and any(len(w) < 6 for w in want)
