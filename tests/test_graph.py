"""Graph operators, search and builds on small fixtures."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import markup
from loomgraph.operators import graph, iterative
from loomgraph.plans import build, publish, search
from loomgraph.sources import pages, sinks
from loomgraph.streaming import ingest

NODES = "id string, title string, subtype string, ord long, content string, tags array<string>, aliases array<string>, category string, entry_type string"


@pytest.fixture(scope="module")
def mini(spark):
    rows = [("a", "A", "domain"), ("b", "B", "tutorial"), ("c", "C", "parameter"), ("d", "D", "parameter"), ("e", "E", "generic"), ("f", "F", "pitfall")]
    n = spark.createDataFrame([(i, t, s, k, f"text of {t} page. More of it.", ["x"], [], "", "capability") for k, (i, t, s) in enumerate(rows)], NODES)
    e = [("a", "b", "contains"), ("a", "b", "wikilink"), ("b", "a", "belongs_to"), ("b", "c", "wikilink"), ("c", "d", "wikilink"), ("d", "b", "wikilink"), ("d", "ghost", "wikilink"), ("c", "a", "belongs_to"), ("e", "a", "wikilink")]
    return n, spark.createDataFrame([(*x, k) for k, x in enumerate(e)], "source string, target string, relation string, ord long")


def rows(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}


def test_dedup(spark):
    n = spark.createDataFrame(
        [("P_1", "Title", "", 0, "short", ["x"], [], "", ""), ("P_2", "title ", "", 1, "much longer", ["y"], ["old"], "", ""), ("Category_T", "Category:Title", "", 2, "c", [], [], "", ""), ("Category_talk_T", "Title", "", 3, "t", [], [], "", ""), ("P_3", "other_one", "", 4, "o", [], [], "", ""), ("P_4", "Other One", "", 5, "o", [], [], "", "")], NODES
    )
    e = spark.createDataFrame([("P_1", "P_3", "wikilink", 0), ("P_2", "P_4", "wikilink", 1), ("P_1", "P_2", "wikilink", 2), ("P_1", "P_4", "contains", 3), ("zzz", "P_1", "wikilink", 4)], "source string, target string, relation string, ord long")
    kept, edges = build.canonical(n, e)
    got = {r.id: r for r in kept.collect()}
    assert set(got) == {"P_2", "Category_T", "Category_talk_T", "P_3"}
    assert got["P_2"].tags == ["x", "y"] and got["P_2"].aliases == ["Title", "old", "title "]
    assert rows(edges, "source", "target", "relation") == {("P_2", "P_3", "wikilink"), ("P_2", "P_3", "contains"), ("zzz", "P_2", "wikilink")}
    again, same = build.canonical(kept.select(*n.columns), edges)
    assert rows(again, "id") == rows(kept, "id") and rows(same, "source", "target") == rows(edges, "source", "target")


def test_graph_operators(mini):
    n, e = mini
    assert rows(graph.dangling_edges(e, n), "target") == {("ghost",)}
    assert graph.internal_edges(e, n).count() == 8
    deg = {r.id: r.degree for r in graph.degrees(graph.internal_edges(e, n), n).collect()}
    assert deg == {"a": 5, "b": 5, "c": 3, "d": 2, "e": 1, "f": 0}
    assert [r.id for r in graph.hubs(e, n, 2).collect()] == ["a", "b"]
    assert rows(graph.orphans(e, n), "id") == {("e",), ("f",)}
    assert rows(graph.first_links(e).where("source = 'a'"), "target", "relation") == {("b", "contains")}
    m = {r.source_type: r.asDict() for r in graph.type_matrix(e, n).collect()}
    assert len(m) == 6 and m["domain"]["tutorial"] == 2 and m["pitfall"]["domain"] == 0
    assert rows(graph.tiered_match(n, "b"), "id", "tier") == {("b", 1)}
    assert rows(graph.tiered_match(n, "text of c"), "id", "tier") == {("c", 3)}
    assert rows(graph.closure(e, n.where("id = 'e'")), "id") == {("e",), ("a",)}
    s = graph.seed_scores(e, n.where("id in ('a', 'b')"), default=("X",))
    assert rows(s, "id", "score") == {("a", -1)}
    assert rows(graph.seed_scores(e, n.where("id = 'f'"), default=("X",)), "id") == {("X",)}


def test_bfs_and_pagerank(mini):
    n, e = mini
    assert rows(iterative.bfs_levels(e, n.where("id = 'a'")), "id", "level") == {("a", 0), ("b", 1), ("c", 2), ("d", 3), ("ghost", 4)}
    assert rows(iterative.bfs_levels(e, n.where("id = 'a'"), 1), "id") == {("a",), ("b",)}
    r = {x.id: x.score for x in iterative.pagerank(e, normalise=False).collect()}
    assert abs(sum(r.values()) - 1) < 1e-9 and max(r, key=r.get) in ("a", "b") and "ghost" in r
    assert iterative.pagerank(e.limit(0)).count() == 0


@pytest.fixture(scope="module")
def index(spark):
    docs = [("d0", "Alpha", "magnet spin alpha beta"), ("d1", "Beta", "beta gamma " + "filler " * 29 + "delta"), ("d2", "Gamma", "beta " + "filler " * 30 + "zeta delta"), ("d3", "Empty", ""), ("d4", "ENCUT", "cutoff energy"), ("d5", "Other", "nothing here")]
    n = spark.createDataFrame([(i, t, "parameter" if t == "ENCUT" else "tutorial", k, c, [], [], "", "") for k, (i, t, c) in enumerate(docs)], NODES)
    return n, search.build(n)


def ask(spark, *q):
    return spark.createDataFrame([(str(i), x) for i, x in enumerate(q)], "qid string, query string")


def test_bm25_by_hand(spark, index):
    import math

    n, i = index
    got = search.bm25(i, ask(spark, "alpha")).first()
    dl, avg = 7, sum(r.length for r in i.docs.collect()) / 6
    idf = math.log((6 - 1 + 0.5) / 1.5 + 1)
    assert got.id == "d0" and abs(got.score - idf * 4 * 2.5 / (4 + 1.5 * (0.25 + 0.75 * dl / avg))) < 1e-6
    near = {r.id: r.n_near for r in search.bm25(i, ask(spark, "gamma delta")).collect()}
    assert near == {"d1": 2, "d2": 0}


def test_spelling_and_search(spark, index):
    n, i = index
    fixed = rows(search.corrections(i, spark.createDataFrame([("gammo",), ("gamma",), ("qqqqq",)], "word string")), "word", "correction")
    assert fixed == {("gammo", "gamma")}
    e = spark.createDataFrame([("d0", "d1", "wikilink", 0), ("d1", "d2", "wikilink", 1)], "source string, target string, relation string, ord long")
    ranks, pairs = iterative.pagerank(e), graph.neighbor_pairs(e)
    out = search.search(i, ask(spark, "encut", "the of", "gammo"), pairs, ranks, limit=3)
    top = {r.qid: r.id for r in out.where("rank = 1").collect()}
    assert top["0"] == "d4" and top["1"] == "d2" and top["2"] in ("d1", "d2")
    only = search.search(i, ask(spark, "beta"), pairs, ranks, subtype="parameter")
    assert only.count() == 0
    parts = search.search(i, ask(spark, "beta").repartition(3), pairs.repartition(3), ranks, limit=3)
    assert rows(parts, "rank", "id") == rows(search.search(i, ask(spark, "beta"), pairs, ranks, limit=3), "rank", "id")


def test_index_round_trip(spark, index, tmp_path):
    _, i = index
    i.write(str(tmp_path))
    again = search.Index.read(spark, str(tmp_path))
    q = ask(spark, "beta delta")
    assert rows(search.bm25(again, q), "id", "score") == rows(search.bm25(i, q), "id", "score")


def page(title, links="", cats="", text="Some body text."):
    ls = "".join(f'<a href="{x}.html">{x}</a>' for x in links.split())
    cs = "".join(f'<a title="Category:{c}">c</a>' for c in cats.split())
    return f'<title>{title} - The Wiki</title><div class="mw-parser-output"><p>{text}</p>{ls}<div id="catlinks"><div id="mw-normal-catlinks">{cs}</div></div>'


WIKI = {"Start": page("Start", "Next Start Gone", "Files"), "Next": page("Next", "Start"), "Talk_x": page("Talk"), "Blank": page("Blank", text="There is currently no text in this page."), "Twin_1": page("Twin"), "Twin_2": page("Twin", text="A longer body text here.")}


def test_build_from_files_and_publish(spark, tmp_path):
    for k, html in WIKI.items():
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"{k}.html").write_bytes(html.encode() + (b"\xff" if k == "Next" else b""))
    parsed = iterative.cut(build.parse(pages.html_files(spark, str(tmp_path / "in"))))
    nodes, edges = build.nodes_of(parsed), build.edges_of(parsed)
    assert rows(nodes, "id") == {("Start",), ("Next",), ("Twin_1",), ("Twin_2",)}
    nodes, edges = (iterative.cut(x) for x in build.canonical(nodes, edges))
    assert rows(edges.where("source = 'Start'"), "target", "relation") == {("Next", "wikilink"), ("Gone", "wikilink"), ("Category_Files", "belongs_to")}
    assert ("Twin_2",) in rows(nodes, "id") and nodes.count() == 3
    md = {r.id: r.markdown for r in publish.pages_markdown(build.enrich(nodes), edges, build.link_contexts(nodes)).collect()}
    assert "## Links" in md["Start"] and "[[Next|Next]] (wikilink)" in md["Start"] and "## Referenced by" in md["Next"]
    assert sinks.write_pages(publish.pages_markdown(nodes, edges), str(tmp_path / "md")) == 3 and (tmp_path / "md" / "Start.md").exists()
    (tmp_path / "n.json").write_text(sinks.json_text(nodes.select("ord", "id", "title", "tags")))
    back = pages.json_array(spark, str(tmp_path / "n.json"), pages.NODE_SCHEMA)
    assert rows(back, "id") == rows(nodes, "id")
    assert pages.sidecar(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "ctx.json").write_text('{"a": "b"}')
    assert rows(pages.sidecar(spark, str(tmp_path / "ctx.json")), "id", "ctx") == {("a", "b")}
    assert "const nodes=" in sinks.graph_html(nodes, edges)


def test_store_round_trip(spark, mini, tmp_path):
    n, e = mini
    path = str(tmp_path / "s.db")
    with sqlite3.connect(path) as db:
        db.execute("create table entries (id text, title text, slug text, entry_type text, content text, tags text, metadata_json text)")
        db.execute("create table edges (source_id text, target_id text, relation text, weight real)")
    entries = publish.store_entries(n).select("id", "title", "slug", "entry_type", "content", F.to_json(F.split("tags", ",")).alias("tags"), F.lit('{"custom":{"subtype":"pitfall"}}').alias("metadata_json"))
    sinks.write_store(entries, publish.store_edges(e, n).toDF("source_id", "target_id", "relation", "weight"), path)
    assert rows(pages.store_nodes(spark, path), "id", "subtype") == {(x, "pitfall") for x in "abcdef"}
    assert pages.store_links(spark, path).count() == 8


def test_reclassify(mini):
    n, _ = mini

    def provider(prompt):
        if "Title: E" in prompt:
            raise ValueError
        return "procedure:tutorial" if "Title: A" in prompt else "nonsense"

    c = build.reclassify(n, provider, only=("domain", "generic", "pitfall"))
    assert rows(c, "id", "entry_type", "subtype", "llm_valid") == {("a", "procedure", "tutorial", True), ("f", "capability", "pitfall", False)}
    assert build.reclassify(n, None).count() == 0
    assert rows(build.apply_classes(n, c).where("llm_classified"), "id") == {("a",), ("f",)}


def test_model_details(spark, tmp_path):
    qf = "structured struct<quick_facts: struct<tag: string, type: string, default: string, raw_description: string>, definition: string, options: array<struct<value: string, description: string>>, warnings: array<string>>"
    known = (("T", "unknown", "1", "raw"), "old", [("x", "y")], ["w"])
    n = spark.createDataFrame(
        [("d", "Domain", "domain", "text", None), ("e", "Other", "domain", None, None), ("p", "P", "parameter", "c", known), ("q", "Q", "parameter", "c", known), ("t", "Tut", "tutorial", "steps", None), ("z", None, "domain", "", None)],
        f"id string, title string, subtype string, content string, {qf}",
    )

    def provider(prompt):
        if "Title: Other" in prompt:
            raise ValueError
        if "JSON" in prompt:
            return '```json\n{"type": "integer", "definition": "", "options": [{"value": "2", "description": "two"}], "warnings": []}\n```' if "Title: P" in prompt else "no idea"
        return ' "A sentence." ' if "Domain" in prompt else "" if "Define" in prompt else "S"

    d = build.in_rounds(n, lambda x, done: build.define(x, provider, done=done), str(tmp_path / "defs"), rounds=3)
    assert rows(d, "id", "definition") == {("d", "A sentence.")}
    asked_again = build.in_rounds(n.where("id = 'd'"), lambda x, done: build.define(x, lambda _: "new", done=done), str(tmp_path / "defs"), rounds=2)
    assert rows(asked_again, "id", "definition") == {("d", "A sentence.")}
    x = build.detail(n, provider)
    assert rows(x, "id") == {("p",)}
    out = build.apply_found(n, d, x, build.summarise(n, provider))
    got = {r.id: r.structured for r in out.collect()}
    assert got["d"].definition == "A sentence." and got["d"].quick_facts is None and got["e"] is None and got["z"] is None
    assert (got["p"].quick_facts.type, got["p"].quick_facts.tag, got["p"].definition, got["p"].warnings) == ("integer", "T", "old", ["w"])
    assert [tuple(o) for o in got["p"].options] == [("2", "two")]
    assert got["q"].quick_facts.type == "unknown" and got["t"].tutorial_summary == "S"
    assert tuple(build.coverage(out).first()) == (2, 2, 1, 1, 0)
    assert build.define(n, None).count() == build.detail(n, None).count() == 0
    assert build.apply_found(out).schema == out.schema


def test_stream_ingest(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate(WIKI.items())], "id string, html string, ord long").write.parquet(src)
    for _ in range(2):
        ingest.ingest(ingest.page_stream(spark, src), str(tmp_path / "out"), str(tmp_path / "cp"), markup.MEDIAWIKI).awaitTermination()
    assert ingest.latest(spark, str(tmp_path / "out")).count() == 4


def test_documents_that_share_an_id_have_their_terms_once(spark):
    docs = [("x", 0, "Kilo", "alpha beta alpha", "generic"), ("x", 1, "Lima", "beta gamma", "generic"), ("y", 2, "Mike", "beta", "generic")]
    i = search.build(spark.createDataFrame(docs, "id string, ord long, title string, content string, subtype string"))
    got = {(r.stem, r.id): (r.tf, r.positions) for r in i.postings.collect()}
    assert got[("beta", "x")] == (2, [3, 4]) and got[("alpha", "x")] == (2, [3, 5]) and len(got) == 7
    assert {r.stem: r.df for r in i.stems.collect()}["beta"] == 2


def test_hits_are_not_shuffled_and_the_best_are_those_of_all(spark):
    """Half the documents have all of the query's words: all that leaves a task are the best of each query."""
    words = ["red", "blue", "green", "amber"]
    docs = [(f"d{k:04}", k, "T", " ".join(words[j] for j in range(4) if k >> j & 1) + " pad" * (k % 37), "generic") for k in range(2000)]
    n = spark.createDataFrame(docs, "id string, ord long, title string, content string, subtype string").repartition(3)
    i = search.build(n)
    q = ask(spark, "red blue", "green amber", "blue amber red")
    every = search.bm25(i, q, limit=None).collect()
    best = search.bm25(i, q, limit=5)
    want = sorted((r.qid, r.rank, r.id, r.score, r.n_near) for r in every if r.rank <= 5)
    assert sorted((r.qid, r.rank, r.id, r.score, r.n_near) for r in best.collect()) == want and len(want) == 15
    batch = search.scan.Batch([(r.qid, r.stem, r.idf) for r in search.query_stems(i, q).join(i.stems, "stem").collect()], 20.0, (search.scan.Run(),), 5)
    assert search.scan.scored(i.entries.repartition(3), batch).count() < len(every) / 4


def test_spelling_of_long_words_and_of_two_letters(spark):
    import random

    r = random.Random(5)
    words = ["".join(r.choice("abc") for _ in range(n)) for n in [*range(5, 40)] * 12]

    def spoil(w):
        for _ in range(r.randint(1, 3)):
            k, c = r.randint(2, len(w) - 1), r.choice("abcq")
            w = r.choice([w[:k] + w[k + 1 :], w[:k] + c + w[k:], w[:k] + c + w[k + 1 :]])
        return w

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, last = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    i = search.build(spark.createDataFrame([("d", 0, "", " ".join(words), "generic")], "id string, ord long, title string, content string, subtype string"))
    known = {x.word for x in i.vocabulary.collect()} | {x.stem for x in i.stems.collect()}
    odd = sorted({spoil(w) for w in words} - known)
    want = {}
    for w in odd:
        near = [(d, c) for c in set(words) if c[:2] == w[:2] and abs(len(c) - len(w)) <= 2 and (d := distance(w, c)) <= 2]
        if near and len(w) >= 4:
            want[w] = min(near)
    got = {x.word: (x.distance, x.correction) for x in search.corrections(i, spark.createDataFrame([(w,) for w in odd], "word string")).collect()}
    assert got == want and {d for d, _ in want.values()} == {1, 2} and max(map(len, want)) > 30


def test_edges_are_dealt_by_the_size_of_the_input(spark, tmp_path, monkeypatch):
    e = [(f"n{k % 50}", f"n{k * 7 % 60}", "wikilink", k) for k in range(3000)]
    spark.createDataFrame(e, "source string, target string, relation string, ord long").write.parquet(str(tmp_path / "e"))
    edges = spark.read.parquet(str(tmp_path / "e"))
    nodes = spark.createDataFrame([(f"n{k % 40}",) for k in range(80)], "id string")  # each id twice
    assert iterative.dealt(edges, "source").rdd.getNumPartitions() == edges.rdd.getNumPartitions()
    size = sum(f.stat().st_size for f in (tmp_path / "e").glob("*.parquet"))
    monkeypatch.setattr(iterative, "SMALL", 0)
    monkeypatch.setattr(iterative, "SHARE", size // 30)
    assert graph.internal_edges(edges, nodes).rdd.getNumPartitions() >= 25
    assert graph.dedup_edges(edges).rdd.getNumPartitions() >= 25
    have = {f"n{k}" for k in range(40)}
    assert sorted(rows(graph.internal_edges(edges, nodes), "source", "target", "ord")) == sorted((s, t, o) for s, t, _, o in e if s in have and t in have)


def test_pagerank_works_out_sinks_in_the_last_round(spark):
    pairs = [(f"s{k % 7}", f"t{k % 11}") for k in range(60)] + [("t1", "s0"), ("t2", "s3"), ("t2", "s4")]
    e = spark.createDataFrame([(a, b, "wikilink", 0) for a, b in pairs], "source string, target string, relation string, ord long")
    links = {a: {y for x, y in pairs if x == a} for a, _ in pairs}
    every = sorted({x for p in pairs for x in p})
    score = dict.fromkeys(every, 1 / len(every))
    for _ in range(10):
        lost = sum(score[x] for x in every if x not in links)
        fresh = dict.fromkeys(every, 0.15 / len(every) + 0.85 * lost / len(every))
        for a, to in links.items():
            for b in to:
                fresh[b] += 0.85 * score[a] / len(to)
        score = fresh
    for tolerance in (None, 0.0):
        got = {r.id: r.score for r in iterative.pagerank(e, rounds=10, tolerance=tolerance, normalise=False).collect()}
        assert got.keys() == score.keys() and all(abs(got[x] - score[x]) < 1e-12 for x in every)
