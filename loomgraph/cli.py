"""Command line: ``python -m loomgraph <command>``. Graphs are kept as Parquet folders
``<graph>/nodes`` and ``<graph>/edges``; ``<graph>/contexts`` is optional."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph import session
from loomgraph.functions import markup
from loomgraph.operators import graph, iterative
from loomgraph.plans import build, publish, search
from loomgraph.sources import pages, sinks

# fixed value: seeds used when probing finds none
DEFAULT_SEEDS = ("Category_VASP", "INCAR", "POSCAR", "KPOINTS", "POTCAR")


def load(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """A graph from its Parquet folder, or from a pair of JSON arrays 'nodes.json,edges.json'."""
    if "," in path:
        n, e = path.split(",")
        order = F.monotonically_increasing_id().alias("ord")
        return pages.json_array(spark, n, pages.NODE_SCHEMA).select("*", order), pages.json_array(spark, e, pages.EDGE_SCHEMA).select("*", order)
    return spark.read.parquet(f"{path}/nodes"), spark.read.parquet(f"{path}/edges")


def save(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").parquet(f"{path}/edges")


def extract(spark: SparkSession, args: argparse.Namespace) -> None:
    """Pages to a graph: all of a folder, or what seeds reach."""
    # written once: every later step reads parts of it
    parsed = iterative.cut(build.parse(pages.html_files(spark, args.wiki), markup.ARTICLE if args.layout == "article" else markup.MEDIAWIKI))
    if args.seeds or args.auto_seeds:
        names = args.seeds.split(",") if args.seeds else list(DEFAULT_SEEDS)
        seeds = spark.createDataFrame([(s,) for s in names], "id string")
        if args.auto_seeds:
            seeds = graph.seed_scores(build.edges_of(parsed, crawl=True), seeds, default=DEFAULT_SEEDS).select("id")
        nodes, edges = build.crawl(parsed, seeds, args.depth or None)
    else:
        nodes, edges = build.nodes_of(parsed), build.edges_of(parsed)
    if not args.no_dedup:
        nodes, edges = build.canonical(nodes, edges)
    nodes, edges = iterative.cut(nodes), iterative.cut(edges)
    nodes = nodes if args.no_enrich else build.enrich(nodes)
    save(nodes, edges, args.output)
    build.link_contexts(nodes).write.mode("overwrite").parquet(f"{args.output}/contexts")


def stats(spark: SparkSession, args: argparse.Namespace) -> None:
    nodes, edges = load(spark, args.graph)
    for df, c in ((nodes, "entry_type"), (nodes, "subtype"), (edges, "relation")):
        graph.count_by(df, c).show(50, truncate=False)


def markdown(spark: SparkSession, args: argparse.Namespace) -> None:
    nodes, edges = load(spark, args.graph)
    md = publish.pages_markdown(nodes, edges)
    if args.single_file:
        sinks.write_single(nodes, md, args.output)
    else:
        print(sinks.write_pages(md, args.output), "pages")


def kb_json(spark: SparkSession, args: argparse.Namespace) -> None:
    for name, df in publish.kb_document(*load(spark, args.graph)).items():
        sinks.write_json(df, f"{args.output}/{name}")


def view(spark: SparkSession, args: argparse.Namespace) -> None:
    nodes, edges = load(spark, args.graph)
    with open(args.output, "w", encoding="utf-8") as f:
        f.write(sinks.graph_html(nodes, edges, args.max))


def import_store(spark: SparkSession, args: argparse.Namespace) -> None:
    nodes, edges = load(spark, args.graph)
    e = publish.store_entries(nodes).select("id", "title", "slug", "entry_type", "content", F.to_json(F.split("tags", ",")).alias("tags"), F.lit("{}").alias("metadata_json"))
    sinks.write_store(e, publish.store_edges(edges, nodes).toDF("source_id", "target_id", "relation", "weight"), args.db)


def lookup(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = spark.createDataFrame([(p,) for p in args.pages], "name string")
    kb = load(spark, args.graph)[0].select("id", "title")
    wiki = build.parse(pages.html_files(spark, args.wiki)).select("id", "title") if args.wiki else kb.limit(0)
    for r in publish.lookup_pages(requests, kb, wiki).toJSON().toLocalIterator():
        print(r)


class Searcher:
    """Index, neighbours and ranks of a graph, kept in memory for single queries."""

    def __init__(self, spark: SparkSession, nodes: DataFrame, edges: DataFrame):
        self.spark, self.nodes = spark, nodes
        self.index = search.build(nodes)
        for t in search.Index.TABLES:
            setattr(self.index, t, getattr(self.index, t).persist())
        self.pairs = graph.neighbor_pairs(edges).persist()
        self.ranks = iterative.pagerank(edges).persist()

    def __call__(self, q: str, limit: int = 10, subtype: str | None = None) -> dict:
        batch = self.spark.createDataFrame([("0", q)], "qid string, query string")
        words = batch.select(F.explode(search.terms.query_tokens(F.col("query"))).alias("word"))
        fixed = [{"from": r.word, "to": r.correction} for r in search.corrections(self.index, words).collect()]
        hits = search.search(self.index, batch, self.pairs, self.ranks, limit, subtype).orderBy("rank")
        return {"query": q, "spell_corrections": fixed or None, "subtype_filter": subtype, "results": (rows := [r.asDict() for r in hits.collect()]), "total": len(rows)}


def find(spark: SparkSession, args: argparse.Namespace) -> None:
    print(json.dumps(Searcher(spark, *load(spark, args.graph))(args.query, args.limit, args.subtype), ensure_ascii=False, indent=1))


def serve(spark: SparkSession, args: argparse.Namespace) -> None:
    """GET /search?q=&limit=&subtype= and /health."""
    from http.server import BaseHTTPRequestHandler, HTTPServer
    from urllib.parse import parse_qs, urlparse

    nodes, edges = load(spark, args.graph)
    ask, n = Searcher(spark, nodes, edges), nodes.count()

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            url = urlparse(self.path)
            q = {k: v[0] for k, v in parse_qs(url.query).items()}
            if url.path == "/health":
                code, out = 200, {"status": "ok", "nodes": n}
            elif url.path == "/search" and "q" in q and q.get("limit", "10").isdigit() and 1 <= int(q.get("limit", "10")) <= 100:
                code, out = 200, ask(q["q"], int(q.get("limit", "10")), q.get("subtype"))
            else:
                code, out = 422 if url.path == "/search" else 404, {"error": "bad request"}
            self.send_response(code)
            self.send_header("Content-Type", "application/json")
            self.end_headers()
            self.wfile.write(json.dumps(out, ensure_ascii=False).encode())

    HTTPServer(("127.0.0.1", args.port), Handler).serve_forever()


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="loomgraph")
    sub = p.add_subparsers(required=True)

    def command(name: str, run, *options: tuple) -> None:
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for flags, kw in options:
            c.add_argument(*flags.split(), **kw)

    g, out = ("graph", {}), ("--output", {"required": True})
    command("extract", extract, ("wiki", {}), out, ("--seeds", {}), ("--auto-seeds", {"action": "store_true"}), ("--depth", {"type": int, "default": 0}), ("--layout", {"choices": ["mediawiki", "article"], "default": "mediawiki"}), ("--no-dedup", {"action": "store_true"}), ("--no-enrich", {"action": "store_true"}))
    command("stats", stats, g)
    command("markdown", markdown, g, out, ("--single-file", {"action": "store_true"}))
    command("json", kb_json, g, out)
    command("view", view, g, out, ("--max", {"type": int, "default": 2000}))
    command("import", import_store, g, ("--db", {"required": True}))
    command("lookup", lookup, g, ("pages", {"nargs": "+"}), ("--wiki", {}))
    command("search", find, g, ("query", {}), ("--limit", {"type": int, "default": 10}), ("--subtype", {}))
    command("serve", serve, g, ("--port", {"type": int, "default": 8766}))
    args = p.parse_args(argv)
    args.run(session.session(), args)


if __name__ == "__main__":
    main()
