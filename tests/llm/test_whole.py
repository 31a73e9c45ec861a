"""Groups and passages on which a shortened search loses something."""

import collections

import numpy as np
import pytest

from loomgraph.llm import near_dedup, suffix_dedup, window_dedup
from loomgraph.llm._shared import shingle_set


def edited(rng, base, n):
    out = list(base)
    for k in rng.choice(len(out), n, replace=False):
        out[k] = f"e{rng.integers(10**9)}"
    return out


def test_large_group_of_loose_copies(spark):
    """Copies of which few are similar enough to any one of the others."""
    rng = np.random.default_rng(7)
    base = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join(edited(rng, base, 4))) for i in range(900)]
    sets = [shingle_set(t) for _, t in rows]
    names = np.unique(np.concatenate(sets))
    has = np.zeros((len(rows), len(names)), np.float32)
    for i, s in enumerate(sets):
        has[i, np.searchsorted(names, s)] = 1
    size, both = has.sum(axis=1), has @ has.T
    near = 100 * both >= 75 * (size[:, None] + size[None, :] - both)
    label = np.arange(len(rows))
    while True:
        low = np.where(near, label[None, :], len(rows)).min(axis=1)
        if (low == label).all():
            break
        label = low
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).select("doc_id", "component_id").collect()
    assert sorted(tuple(r) for r in got) == list(enumerate(label.tolist()))


def test_pairs_inside_a_template(spark):
    """Every pair that reaches 0.75 within a crowd of texts that do not."""
    rng = np.random.default_rng(12)
    base = [f"w{i}" for i in range(240)]
    rows = []
    for p in range(200):
        places = rng.choice(240, 4, replace=False)
        both = list(base)
        for k in places[:1]:
            both[k] = f"p{p}_{k}"
        for side in range(2):
            own = list(both)
            for k in rng.choice(240, 3, replace=False):
                own[k] = f"e{rng.integers(10**9)}"
            rows.append((2 * p + side, " ".join(own)))
    sets = [set(shingle_set(t).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).select("doc_id", "component_id").collect()
    assert sorted(tuple(r) for r in got) == [(i, find(i)) for i in range(len(rows))]


@pytest.mark.parametrize("size,at,more", [(90, 45, 8), (90, 30, 8), (99, 50, 12), (96, 40, 10)])
def test_passage_with_a_changed_clause(size, at, more):
    """Words put in between take a passage apart, but leave it at 0.75."""
    p = [f"w{i}" for i in range(size)]
    a = " ".join([f"a{i}" for i in range(60)] + p + [f"b{i}" for i in range(60)])
    b = " ".join([f"c{i}" for i in range(20)] + p[:at] + [f"new{i}" for i in range(more)] + p[at:] + [f"d{i}" for i in range(60)])
    for seed in (60 + at - 10, 60 + at + 4):
        shift = -40 if seed < 60 + at else -40 + more
        assert window_dedup.verify(a, b, [{"c": seed, "c_b": seed + shift}]) == [(60, 60 + size, 20, 20 + size + more)]


def test_two_passages_of_one_chain():
    """Too wide a gap between passages costs neither of them."""
    p, q = [f"w{i}" for i in range(100)], [f"v{i}" for i in range(90)]
    a, b = " ".join([*p, *q]), " ".join([*p, *(f"new{i}" for i in range(58)), *q])
    assert sorted(window_dedup.verify(a, b, [{"c": 50, "c_b": 50}])) == [(0, 100, 0, 100), (100, 190, 158, 248)]


@pytest.mark.parametrize("find", [suffix_dedup.repeated_passages, window_dedup.near_passages])
def test_passage_many_times_in_one_document(spark, find):
    """Ranges that part a key keep no document from its only partner."""
    spark.conf.set("spark.sql.shuffle.partitions", "13")  # a key's rows are dealt to several tasks
    rng = np.random.default_rng(3)
    text = lambda n: [f"q{x}" for x in rng.integers(0, 10**6, n)]
    rows = []
    for i in range(0, 12, 2):
        p = text(60)
        rows.append((i, " ".join(w for _ in range(40) for w in p + text(9))))
        rows.append((i + 1, " ".join(text(50) + p + text(50))))
    got = find(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "other_doc_id").collect()
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert {tuple(r) for r in got} == {(i, i ^ 1) for i in range(12)}


def test_passages_of_loose_copies(spark):
    """Every word in 50 that another document has, among many copies that differ in a few words."""
    rng = np.random.default_rng(5)
    base = [f"w{i}" for i in range(400)]
    texts = [edited(rng, base, int(rng.integers(5, 8))) for _ in range(200)]
    seen = collections.Counter(tuple(t[i : i + 50]) for t in texts for i in range(351))
    want = {(d, k) for d, t in enumerate(texts) for i in range(351) if seen[tuple(t[i : i + 50])] > 1 for k in range(i, i + 50)}
    found = suffix_dedup.repeated_passages(spark.createDataFrame([(d, " ".join(t)) for d, t in enumerate(texts)], "doc_id long, text string")).collect()
    got = set()
    for r in found:
        first = " ".join(texts[r.doc_id])[: r.start].count(" ")
        got |= {(r.doc_id, k) for k in range(first, first + r.n_words)}
    assert got == want


def test_compact_windows_are_nodes_of_the_cartesian_tree():
    rng = np.random.default_rng(21)
    texts = [rng.integers(0, 2**63, n, dtype=np.uint64) for n in (46, 60, 300, 1500, 47)]
    doc, key, _, fn, lo, c, hi = window_dedup.compact_windows(texts)
    got = {tuple(x) for x in zip(doc.tolist(), fn.tolist(), lo.tolist(), c.tolist(), hi.tolist())}
    want = set()
    for d, g in enumerate(texts):
        for k, seed in enumerate(window_dedup._SEEDS):
            v = window_dedup.mix(g ^ seed).tolist()

            def node(a, b):
                if b - a + 1 < window_dedup.SPAN:
                    return
                m = min(range(a, b + 1), key=v.__getitem__)  # noqa: B023
                want.add((d, k, a, m, b))  # noqa: B023
                node(a, m - 1)
                node(m + 1, b)

            node(0, len(g) - 1)
    assert got == want


def test_near_passages_of_many_documents(spark):
    """Recall in a crowd: one passage in 300 documents, each with its own edits, at 0.75 or more to some other."""
    rng = np.random.default_rng(31)
    base = [f"w{i}" for i in range(110)]
    rows, where = [], {}
    for d in range(300):
        p = edited(rng, base, int(rng.integers(0, 4)))
        front = [f"q{x}" for x in rng.integers(0, 10**9, 40)]
        rows.append((d, " ".join([*front, *p, *(f"z{x}" for x in rng.integers(0, 10**9, 40))])))
        where[d] = range(40, 150)
    found = window_dedup.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = collections.Counter()
    for r in found:
        first = dict(rows)[r.doc_id][: r.start].count(" ")
        got[r.doc_id] += len(set(range(first, first + r.n_words)) & set(where[r.doc_id]))
    assert sum(got.values()) >= 0.97 * 110 * 300
