"""Batch build: pages -> nodes and edges -> canonical graph -> structured facts."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomgraph.functions import classify, cleaning, facts, fixed, markup, text
from loomgraph.operators import graph, iterative

BODY_CAP, RAW_CAP, CRAWL_TAGS = 16000, 4000, 8


def parse(pages: DataFrame, profile: markup.HtmlProfile = markup.MEDIAWIKI, clean: bool = True) -> DataFrame:
    """pages(id, html, ord) -> id, ord, title, body, raw_html, links, categories,
    subcategories, members. Never fails on a page; missing parts are empty."""
    html = F.coalesce(F.col("html"), F.lit(""))
    raw = markup.body_html(html, profile)
    md = markup.to_markdown(raw)
    return pages.select(
        "id", "ord", markup.title(html, F.col("id"), profile).alias("title"),
        F.left(cleaning.clean_text(md) if clean else md, F.lit(BODY_CAP)).alias("body"), F.left(raw, F.lit(RAW_CAP)).alias("raw_html"),
        markup.links(html, profile).alias("links"), markup.categories(html, profile).alias("categories"),
        markup.subcategories(html, profile).alias("subcategories"), markup.members(html, profile).alias("members"),
    )


def nodes_of(parsed: DataFrame, crawl: bool = False) -> DataFrame:
    """Nodes of content pages; ``crawl`` caps tags and knows no stub rule."""
    ok = parsed.where(~classify.excluded(F.col("id")) & ~classify.empty_page(F.col("body"), stub=not crawl))
    kind = classify.by_page(F.col("id"), F.col("categories"))
    tags = F.slice("categories", 1, CRAWL_TAGS) if crawl else F.col("categories")
    out = ok.withColumn("kind", kind)
    return out.select(
        "id", "ord", "title", "kind.entry_type", "kind.subtype", F.col("body").alias("content"), "raw_html",
        tags.alias("tags"), F.array().cast("array<string>").alias("aliases"), F.coalesce(F.get("categories", F.lit(0)), F.lit("")).alias("category"),
    )


def edges_of(parsed: DataFrame, crawl: bool = False) -> DataFrame:
    """Edges of content pages, repeats dropped, with a dense-enough order column."""
    ok = parsed.where(~classify.excluded(F.col("id")))
    e = graph.link_edges(ok, "structural" if crawl else "none")
    e = e.select("source", "target", "relation", (F.col("page_ord") * F.lit(1_000_000) + F.col("i")).alias("ord"))
    return graph.dedup_edges(e)


def crawl(parsed: DataFrame, seeds: DataFrame, depth: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the pages that ``seeds(id)`` reach along links, to ``depth`` steps.

    Pages of excluded namespaces and empty ones end a path; only levels are iterated, over
    (source, target) pairs, so page texts are not moved."""
    nodes, edges = nodes_of(parsed, crawl=True), edges_of(parsed, crawl=True)
    own = edges.join(nodes.select(F.col("id").alias("source")), "source", "left_semi")
    reached = iterative.bfs_levels(own, seeds, depth).select("id")
    return nodes.join(reached, "id", "left_semi"), own.join(reached.withColumnRenamed("id", "source"), "source", "left_semi")


def canonical(nodes: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Duplicate nodes merged, edges moved to the kept ones."""
    keyed = nodes.withColumn("key", graph.title_key(F.col("id"), F.col("title")))
    kept = graph.dedup_nodes(nodes)
    table = graph.remap_table(nodes, keyed.join(kept.select("id"), "id", "left_semi"))
    return kept, graph.remap_edges(edges, table)


def enrich(nodes: DataFrame) -> DataFrame:
    """Facts of parameter pages in ``structured``; null for others."""
    f = facts.facts(F.col("content"))
    return nodes.withColumn("structured", F.when(F.col("subtype") == "parameter", f))


def link_contexts(nodes: DataFrame) -> DataFrame:
    """``id, ctx`` for nodes whose content has a usable first sentence."""
    return nodes.select("id", text.link_context(F.coalesce("content", F.lit(""))).alias("ctx")).where("ctx is not null")


# -- model-backed steps ----------------------------------------------------------------

Provider = Callable[[str], str]


def ask(rows: DataFrame, provider: Provider, prompt: str = "prompt", reply: str = "reply") -> DataFrame:
    """``rows`` with the provider's reply to each prompt; 'error' where it raises."""
    schema = T.StructType([*rows.schema.fields, T.StructField(reply, T.StringType())])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(p: str) -> str:
            try:
                return provider(p)
            except Exception:
                return "error"

        for pdf in it:
            pdf[reply] = [one(p) for p in pdf[prompt]]
            yield pdf

    return rows.mapInPandas(run, schema)


def candidates(nodes: DataFrame, done: DataFrame | None = None, only: tuple[str, ...] = (), skip: tuple[str, ...] = ()) -> DataFrame:
    """Nodes still to be classified by a model: not in ``done``, of the subtypes asked for."""
    n = nodes
    if only:
        n = n.where(F.col("subtype").isin(*only))
    if skip:
        n = n.where(~F.col("subtype").isin(*skip))
    return n if done is None else n.join(done.select("id"), "id", "left_anti")


def reclassify(nodes: DataFrame, provider: Provider | None, only: tuple[str, ...] = ("best_practice", "generic", "domain"), done: DataFrame | None = None) -> DataFrame:
    """``id, entry_type, subtype, llm_valid`` for candidates. An unknown class keeps the old
    one but counts as classified; errors give no row. Without a provider there are none."""
    c = candidates(nodes, done, only)
    if provider is None:
        return c.limit(0).select("id", "entry_type", "subtype", F.lit(False).alias("llm_valid"))
    asked = ask(c.select("id", F.col("entry_type").alias("e0"), F.col("subtype").alias("s0"), text.prompt(F.col("title"), F.col("content"), 1500).alias("prompt")), provider)
    a = asked.where("reply != 'error'").withColumn("r", text.split_reply(F.col("reply")))
    ok = F.col("r.entry_type").isin(*fixed.ENTRY_TYPES)
    return a.select("id", F.when(ok, F.col("r.entry_type")).otherwise(F.col("e0")).alias("entry_type"), F.when(ok, F.col("r.subtype")).otherwise(F.col("s0")).alias("subtype"), ok.alias("llm_valid"))


def apply_classes(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """Nodes with the classes found so far, and whether a model gave them."""
    c = classes.select("id", F.col("entry_type").alias("e1"), F.col("subtype").alias("s1"))
    out = nodes.join(c, "id", "left")
    return out.withColumn("entry_type", F.coalesce("e1", "entry_type")).withColumn("subtype", F.coalesce("s1", "subtype")).withColumn("llm_classified", F.col("e1").isNotNull()).drop("e1", "s1")


def unclear_facts(enriched: DataFrame) -> DataFrame:
    """Parameters whose type the rules could not tell."""
    return enriched.where("subtype = 'parameter' and structured.quick_facts.type = 'unknown'")


def summarise(nodes: DataFrame, provider: Provider | None, subtype: str = "tutorial", chars: int = 3000, done: DataFrame | None = None) -> DataFrame:
    """``id, summary`` by a model for nodes of a subtype that have none; errors are not stored."""
    c = candidates(nodes, done, (subtype,))
    if provider is None:
        return c.limit(0).select("id", F.lit("").alias("summary"))
    asked = ask(c.select("id", text.prompt(F.col("title"), F.col("content"), chars).alias("prompt")), provider)
    return asked.where("reply != 'error'").select("id", F.trim("reply").alias("summary"))


#: What a model is asked for.
ASK_DEFINITION = "Define the subject of this page in one sentence. Answer with that sentence only.\n\nTitle: %s\nContent: %s"
ASK_DETAILS = (
    "Describe the input parameter of this page as one JSON object with the keys type (string), definition (string), "
    "options (array of objects with value and description) and warnings (array of strings). Use empty values for what "
    "the page does not say. Answer with the JSON only.\n\nTitle: %s\nContent: %s"
)
DETAILS = "type string, definition string, options array<struct<value: string, description: string>>, warnings array<string>"
DETAILS_FIELDS = "type: string, definition: string, options: array<struct<value: string, description: string>>, warnings: array<string>"


def define(enriched: DataFrame, provider: Provider | None, subtype: str = "domain", chars: int = 1500, done: DataFrame | None = None) -> DataFrame:
    """``id, definition`` by a model for nodes of a subtype that have none; errors and empty replies are not stored."""
    c = candidates(enriched, done, (subtype,)).where("coalesce(structured.definition, '') = ''")
    if provider is None:
        return c.limit(0).select("id", F.lit("").alias("definition"))
    asked = ask(c.select("id", text.prompt(F.col("title"), F.coalesce("content", F.lit("")), chars, ASK_DEFINITION).alias("prompt")), provider)
    found = F.regexp_replace(F.trim("reply"), '^"+|"+$', "").alias("definition")
    return asked.where("reply != 'error'").select("id", found).where("definition != ''")


def detail(enriched: DataFrame, provider: Provider | None, chars: int = 2500, done: DataFrame | None = None) -> DataFrame:
    """``id, details`` by a model for parameters of unclear type; replies that are no JSON object are not stored."""
    c = candidates(unclear_facts(enriched), done)
    if provider is None:
        return c.limit(0).select("id", F.from_json(F.lit(None).cast("string"), DETAILS).alias("details"))
    asked = ask(c.select("id", text.prompt(F.col("title"), F.coalesce("content", F.lit("")), chars, ASK_DETAILS).alias("prompt")), provider)
    body = text.unfence(F.col("reply"))
    return asked.where("reply != 'error'").where(body.startswith("{")).select("id", F.from_json(body, DETAILS, {"mode": "PERMISSIVE"}).alias("details")).where("details is not null")


def _filled(new: Column, old: Column) -> Column:
    return F.when(F.length(new) > 0, new).otherwise(old)


def _filled_list(new: Column, old: Column) -> Column:
    return F.when(F.size(new) > 0, new).otherwise(old)


def apply_found(enriched: DataFrame, definitions: DataFrame | None = None, details: DataFrame | None = None, summaries: DataFrame | None = None) -> DataFrame:
    """Nodes with what models found in ``structured``: fields that are not empty replace those of the rules,
    and a summary is kept as ``tutorial_summary``. ``structured`` is null where there is nothing."""
    n = enriched
    for found, name, empty in ((definitions, "definition", "string"), (details, "details", f"struct<{DETAILS_FIELDS}>"), (summaries, "summary", "string")):
        new = f"_new_{name}"
        n = n.withColumn(new, F.lit(None).cast(empty)) if found is None else n.join(found.select("id", F.col(name).alias(new)), "id", "left")
    old, d = F.col("structured"), F.col("_new_details")
    quick = F.when(old["quick_facts"].isNotNull() | (F.length(d["type"]) > 0), F.struct(
        old["quick_facts"]["tag"].alias("tag"), _filled(d["type"], old["quick_facts"]["type"]).alias("type"),
        old["quick_facts"]["default"].alias("default"), old["quick_facts"]["raw_description"].alias("raw_description"),
    ))
    before = old["tutorial_summary"] if "tutorial_summary" in enriched.schema["structured"].dataType.names else F.lit(None).cast("string")
    merged = F.struct(
        quick.alias("quick_facts"), _filled(d["definition"], _filled(F.col("_new_definition"), old["definition"])).alias("definition"),
        _filled_list(d["options"], old["options"]).alias("options"), _filled_list(d["warnings"], old["warnings"]).alias("warnings"),
        _filled(F.col("_new_summary"), before).alias("tutorial_summary"),
    )
    any_new = old.isNotNull() | d.isNotNull() | F.col("_new_definition").isNotNull() | F.col("_new_summary").isNotNull()
    return n.withColumn("structured", F.when(any_new, merged)).drop("_new_definition", "_new_details", "_new_summary")


def in_rounds(rows: DataFrame, step: Callable[[DataFrame, DataFrame | None], DataFrame], path: str, rounds: int = 16) -> DataFrame:
    """All that ``step(rows, done)`` finds, appended to the Parquet folder ``path`` round by round.

    A run that was broken off goes on where it was: ids in ``path`` are ``done`` and
    not asked for again. A round has the rows of one residue of the id's hash."""
    spark = rows.sparkSession
    empty = step(rows.limit(0), None)
    empty.write.mode("append").parquet(path)
    for k in range(rounds):
        part = rows.where(F.pmod(F.xxhash64("id"), F.lit(rounds)) == k)
        step(part, spark.read.schema(empty.schema).parquet(path)).write.mode("append").parquet(path)
    return spark.read.schema(empty.schema).parquet(path)


def coverage(nodes: DataFrame) -> DataFrame:
    """One row: ``n_parameters, n_with_facts, n_tutorials, n_with_summary, n_classified``."""
    has = nodes.schema["structured"].dataType.names if "structured" in nodes.columns else ()
    facts_there = F.col("structured.quick_facts").isNotNull() if "quick_facts" in has else F.lit(False)
    summary_there = F.col("structured.tutorial_summary").isNotNull() if "tutorial_summary" in has else F.lit(False)
    classified = F.col("llm_classified") if "llm_classified" in nodes.columns else F.lit(False)
    return nodes.agg(
        F.count_if(F.col("subtype") == "parameter").alias("n_parameters"), F.count_if((F.col("subtype") == "parameter") & facts_there).alias("n_with_facts"),
        F.count_if(F.col("subtype") == "tutorial").alias("n_tutorials"), F.count_if((F.col("subtype") == "tutorial") & summary_there).alias("n_with_summary"),
        F.count_if(classified).alias("n_classified"),
    )
