import numpy as np

import corpus_pipeline
from loomgraph.llm import embedding_dedup, language_id, near_dedup
from loomgraph.llm._shared import components, Stash


def brute(rows, cosine):
    unit = [embedding_dedup.clean(v) for _, v in rows]
    ok = [i for i, u in enumerate(unit) if u is not None]
    n, parent = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in ok:
        for j in ok:
            if j < i and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= cosine:
                n[i] += 1
                n[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(d, n[i], low.get(find(i))) for i, (d, _) in enumerate(rows)]


def test_near_vectors(spark, monkeypatch):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((60, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[i % 5] + rng.standard_normal(16) * 0.08 * np.linalg.norm(base[i % 5]) / 4).tolist()) for i in range(90)]
    rows += [(300 + i, (2.0 * base[7]).tolist()) for i in range(30)]
    rows += [(500 + i, v) for i, v in enumerate([[*r[1], 0.0] for r in rows[60:100]])]
    rows += [(400, None), (401, []), (402, [0.0] * 16), (403, [1.0] * 15 + [None]), (404, [float("nan")] * 16), (405, [1.0] * 8), (None, base[3].tolist()), rows[2], (406, [float("inf")] + [0.0] * 15)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 as cls", "'u' as unit")
    key = lambda r: tuple(-1 if x is None else x for x in r)
    want = sorted(brute(rows, 0.95), key=key)
    for block in (512, 16):
        monkeypatch.setattr(embedding_dedup, "BLOCK", block)
        got = sorted((tuple(r)[:3] for r in embedding_dedup.near_vectors(df).collect()), key=key)
        assert [g[::2] for g in got] == [w[::2] for w in want]
        assert sum(abs(g[1] - w[1]) for g, w in zip(got, want)) <= 0.002 * sum(w[1] for w in want)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100 + (i * 7) % 50, 100 + (i * 7 + 7) % 50) for i in range(30)] + [(500, 501), (501, 500)]
    got = dict(tuple(r) for r in components(Stash(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect())
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in parent}


def test_pipeline(spark, docs, tmp_path):
    """Each stage by itself: what it drops is what it should, and columns stay."""
    base = docs.select("doc_id", "text", "lang", "source", "n_chars")
    base.write.parquet(str(tmp_path / "documents.parquet"))
    d, seen = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for i, (name, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, d, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == base.columns
            out.write.parquet(str(tmp_path / name))
            out = spark.read.parquet(str(tmp_path / name))
        seen.append((name, d, out))
        d = out
    _, before, after = seen[0]
    gone = {r.text for r in before.exceptAll(after).collect()}
    assert all(t is None or not language_id.has_letter(t) or len(t) < 10 or len(set(t)) < 5 for t in gone) and {None, ""} <= gone
    _, before, after = seen[1]
    found = near_dedup.near_duplicates(before)
    assert after.count() == found.select("grp").where("grp is not null").distinct().count() + found.where("grp is null").count()
    _, before, after = seen[3]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    _, before, after = seen[4]
    assert after.where("start = 0").count() == before.count()
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, run.collect())) == sorted(map(str, after.collect()))
