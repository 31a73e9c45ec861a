"""What is published of a graph: Markdown pages and indexes, JSON sections, vis and store records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import fixed, terms, text
from loomgraph.functions.markup import blank_to_null
from loomgraph.operators import graph

TYPE_RANK = {s: i for i, s in enumerate(fixed.SUBTYPES)}
# fixed values: colours of the graph view
NODE_COLOURS = {"domain": "#e74c3c", "tutorial": "#3498db", "parameter": "#2ecc71", "best_practice": "#f39c12", "pitfall": "#9b59b6", "generic": "#95a5a6"}
EDGE_COLOURS = {"contains": "#e74c3c", "has_subcategory": "#f39c12", "belongs_to": "#3498db", "wikilink": "#95a5a6"}


def type_rank(subtype: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in TYPE_RANK.items() for x in kv]), subtype), F.lit(len(TYPE_RANK)))


def _section(head: str, body: Column) -> Column:
    return F.when(body.isNotNull() & (body != ""), F.concat(F.lit(f"## {head}\n\n"), body))


def link_lines(edges: DataFrame, nodes: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``id, links``: a line for each distinct page linked to, in order, with its context."""
    one = graph.first_links(graph.internal_edges(edges, nodes))
    n = nodes.select(F.col("id").alias("target"), F.col("title").alias("t_title"))
    rows = one.join(n, "target")
    if contexts is not None:
        rows = rows.join(contexts.select(F.col("id").alias("target"), "ctx"), "target", "left")
    else:
        rows = rows.withColumn("ctx", F.lit(None).cast("string"))
    tail = F.when(F.col("ctx").isNotNull(), F.concat(F.lit(" — "), F.col("ctx"))).otherwise("")
    line = F.concat(F.lit("- [["), F.col("target"), F.lit("|"), F.col("t_title"), F.lit("]] ("), F.col("relation"), F.lit(")"), tail)
    lists = rows.groupBy(F.col("source").alias("id")).agg(F.array_sort(F.collect_list(F.struct("ord", line.alias("l")))).alias("x"))
    return lists.select("id", F.array_join(F.transform("x", lambda s: s["l"]), "\n").alias("links"))


def reference_lines(edges: DataFrame, nodes: DataFrame, n: int = 10) -> DataFrame:
    """``id, refs``: the top referring pages, and how many more there are."""
    r = graph.referrers(edges, nodes, n)
    line = F.concat(F.lit("- [["), F.col("source"), F.lit("]] ×"), F.col("n_links").cast("string"))
    lists = r.groupBy(F.col("target").alias("id")).agg(F.array_sort(F.collect_list(F.struct("rank", line.alias("l")))).alias("x"), F.max("n_referrers").alias("all"))
    more = F.when(F.col("all") > n, F.concat(F.lit("\n- … and "), (F.col("all") - n).cast("string"), F.lit(" more"))).otherwise("")
    return lists.select("id", F.concat(F.array_join(F.transform("x", lambda s: s["l"]), "\n"), more).alias("refs"))


def pages_markdown(nodes: DataFrame, edges: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``id, file, markdown``: front matter, facts, definition, options, warnings, summary,
    content (only without facts), links and references; empty sections are left out."""
    n = nodes.join(link_lines(edges, nodes, contexts), "id", "left").join(reference_lines(edges, nodes), "id", "left")
    has = "structured" in nodes.columns
    qf = (lambda c: F.col(f"structured.quick_facts.{c}")) if has else (lambda c: F.lit(None).cast("string"))
    front = F.concat(F.lit("---\nid: "), F.col("id"), F.lit("\ntitle: "), F.col("title"), F.lit("\ntype: "), F.col("subtype"), F.lit("\ntags: ["), F.array_join(F.slice("tags", 1, 8), ", "), F.lit("]\n---"))
    quick = F.when(qf("tag").isNotNull(), F.concat_ws("\n", F.concat(F.lit("- **Tag:** "), qf("tag")), F.concat(F.lit("- **Type:** "), qf("type")), F.concat(F.lit("- **Default:** "), qf("default"))))
    options = F.array_join(F.transform("structured.options", lambda o: F.concat(F.lit("- `"), o["value"], F.lit("` "), o["description"])), "\n") if has else F.lit(None).cast("string")
    warns = F.array_join(F.transform("structured.warnings", lambda w: F.concat(F.lit("> "), w)), "\n") if has else F.lit(None).cast("string")
    body = F.concat_ws(
        "\n\n", front, F.concat(F.lit("# "), F.col("title")), F.concat(F.lit("**"), text.lookup(F.col("subtype"), fixed.SUBTYPE_LABEL, "Generic"), F.lit("**")),
        _section("Quick Facts", quick), _section("Definition", F.col("structured.definition") if has else F.lit(None).cast("string")),
        _section("Options", options), _section("Warnings", warns), _section("Content", F.when(quick.isNull(), F.col("content"))),
        _section("Links", F.col("links")), _section("Referenced by", F.col("refs")),
    )
    return n.select("id", F.concat(text.file_name(F.col("id")), F.lit(".md")).alias("file"), body.alias("markdown"))


def ordered_pages(nodes: DataFrame) -> DataFrame:
    """Nodes in the order of the single file: type, then lower-case title."""
    return nodes.orderBy(type_rank(F.col("subtype")), F.lower("title"), "ord")


def category_index(nodes: DataFrame) -> DataFrame:
    """``category, subtype, n, listing``: titles in order with their first sentences."""
    line = F.concat(F.lit("- "), F.col("title"), F.lit(": "), text.first_sentence(F.col("content")))
    c = F.coalesce(blank_to_null(F.col("category")), F.lit("Uncategorized"))
    g = nodes.groupBy(c.alias("category"), "subtype").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("title", "ord", line.alias("l")))).alias("x"))
    return g.select("category", "subtype", "n", F.array_join(F.transform("x", lambda s: s["l"]), "\n").alias("listing"))


def master_index(nodes: DataFrame) -> DataFrame:
    """``rank, subtype, category, n, titles``: contents by type and category; '' stays ''."""
    g = nodes.groupBy("subtype", "category").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct(F.lower("title").alias("k"), "ord", "title"))).alias("x"))
    return g.select(type_rank(F.col("subtype")).alias("rank"), "subtype", "category", "n", F.array_join(F.transform("x", lambda s: s["title"]), "; ").alias("titles"))


def kb_meta(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: totals (dangling edges included) and counts of each type."""
    e = edges.agg(F.count("*").alias("total_edges"))
    n = nodes.agg(F.count("*").alias("total_nodes"), *[F.count_if(F.col("subtype") == s).alias(f"n_{s}") for s in fixed.SUBTYPES])
    return n.crossJoin(F.broadcast(e))  # one row


def kb_links(nodes: DataFrame, edges: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``source, target, relation, title, subtype, context`` of internal edges; contexts at most 100 characters."""
    e = graph.internal_edges(edges, nodes).join(nodes.select(F.col("id").alias("target"), "title", "subtype"), "target")
    if contexts is None:
        return e.select("source", "target", "relation", "title", "subtype", F.lit("").alias("context"))
    e = e.join(contexts.select(F.col("id").alias("target"), "ctx"), "target", "left")
    return e.select("source", "target", "relation", "title", "subtype", F.coalesce(text.shorten(F.col("ctx"), 100, "…"), F.lit("")).alias("context"))


def kb_pages(nodes: DataFrame, edges: DataFrame, contexts: DataFrame | None = None) -> DataFrame:
    """``id, page``: one JSON object a node, its links inside."""
    links = kb_links(nodes, edges, contexts).groupBy(F.col("source").alias("id")).agg(F.sort_array(F.collect_list(F.struct("target", "relation", "title", "subtype", "context"))).alias("links"))
    n = nodes.join(links, "id", "left")
    own = ["id", "title", "entry_type", "subtype", "content"] + (["structured"] if "structured" in nodes.columns else [])
    return n.select("id", F.to_json(F.struct(*[c for c in own if c in nodes.columns], F.slice("tags", 1, 8).alias("tags"), F.coalesce("links", F.array().cast(n.schema["links"].dataType)).alias("links"))).alias("page"))


def kb_document(nodes: DataFrame, edges: DataFrame, n_hubs: int = 50) -> dict[str, DataFrame]:
    """The sections of the JSON knowledge base as tables."""
    return {
        "meta": kb_meta(nodes, edges),
        "by_subtype": graph.lists_by(nodes, "subtype"),
        "by_category": graph.lists_by(nodes, "category"),
        "hubs": graph.hubs(edges, nodes, n_hubs),
        "cross_reference": graph.type_matrix(graph.internal_edges(edges, nodes), nodes),
        "pages": kb_pages(nodes, edges),
    }


def vis_nodes(nodes: DataFrame) -> DataFrame:
    """Records of the graph view: short label, colour, capped content and tags."""
    return nodes.select("id", F.left("title", F.lit(50)).alias("label"), text.lookup(F.col("subtype"), NODE_COLOURS, "#95a5a6").alias("colour"), F.left("content", F.lit(2000)).alias("content"), F.array_join(F.slice("tags", 1, 10), ", ").alias("tags"))


def vis_edges(edges: DataFrame, nodes: DataFrame, structural: bool = False) -> DataFrame:
    """Distinct internal edges with colour and an arrow on structural ones."""
    e = graph.dedup_edges(graph.internal_edges(edges, nodes))
    if structural:
        e = e.where("relation != 'wikilink'")
    return e.select("source", "target", "relation", text.lookup(F.col("relation"), EDGE_COLOURS, "#95a5a6").alias("colour"), (F.col("relation") != "wikilink").alias("arrow"))


def store_entries(nodes: DataFrame) -> DataFrame:
    """Records for an entry store: slugs made unique by row order, merged tags, index terms."""
    definition = F.col("structured.definition") if "structured" in nodes.columns else F.lit("")
    stems = terms.index_terms(F.col("title"), definition, F.col("content"))
    n = nodes.select("id", "ord", "title", "entry_type", text.slug(F.col("title")).alias("slug"), F.col("tags"), stems.alias("stems"), F.replace("content", F.lit("\\"), F.lit("")).alias("content"))
    again = F.row_number().over(Window.partitionBy("slug").orderBy("ord")) > 1
    slug = F.when(again, F.concat("slug", F.lit("-"), F.col("ord").cast("string"))).otherwise(F.col("slug"))
    return n.withColumn("final", slug).select("id", "title", F.col("final").alias("slug"), "entry_type", F.array_join(terms.merge_tags(F.col("tags"), F.col("stems")), ",").alias("tags"), F.array_join("stems", " ").alias("stems"), "content")


def store_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Internal edges with the store's relation names and weight one."""
    return graph.internal_edges(edges, nodes).select("source", "target", text.lookup(F.col("relation"), fixed.STORE_RELATION, "wikilink").alias("relation"), F.lit(1.0).alias("weight"))


def lookup_pages(requests: DataFrame, kb: DataFrame, wiki: DataFrame, n: int = 5) -> DataFrame:
    """requests(name) -> ``name, source, title, suggestions``: from the knowledge base, else from
    the wiki, else not found, with the first names in order that contain the one asked for."""
    k = kb.select(F.col("id").alias("name"), F.col("title").alias("kb_title"))
    w = wiki.select(F.col("id").alias("name"), F.col("title").alias("wiki_title"))
    r = requests.select("name").distinct().join(k, "name", "left").join(w, "name", "left")
    source = F.when(F.col("kb_title").isNotNull(), "kb").when(F.col("wiki_title").isNotNull(), "wiki").otherwise("not_found")
    r = r.select("name", source.alias("source"), F.coalesce("kb_title", "wiki_title").alias("title"))
    missed = r.where("source = 'not_found'").select("name", F.lower("name").alias("q"))
    near = kb.select("id").join(missed, F.lower("id").contains(F.col("q")))
    rank = F.row_number().over(Window.partitionBy("name").orderBy("id"))
    near = near.withColumn("k", rank).where(F.col("k") <= n).groupBy("name").agg(F.array_join(F.array_sort(F.collect_list("id")), ",").alias("suggestions"))
    return r.join(near, "name", "left").select("name", "source", "title", F.coalesce("suggestions", F.lit("")).alias("suggestions"))
