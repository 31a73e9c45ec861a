"""Relational operators over nodes(id, title, subtype, ord, ...) and edges(source, target, relation, ord).

Edges may dangle. Rows of equal rank are ordered by ``ord``, the place a row had
when it came in, so that results do not depend on partitioning. Small sides are
left to Spark to broadcast by their measured size; nothing is broadcast by hint.
Large tables are dealt out by the size of the input, so that what a task holds does not grow with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import fixed
from loomgraph.functions.markup import blank_to_null
from loomgraph.operators.iterative import dealt


# -- building and reducing edges --------------------------------------------------


def link_edges(pages: DataFrame, self_loops: str = "none") -> DataFrame:
    """Edges of the four link families of parsed pages, in page order.

    Member pages: page contains member; subcategories: page has_subcategory; categories:
    page belongs_to Category_x; internal links: wikilink. ``self_loops`` is "none" or
    "structural" (only wikilinks lose theirs).
    """
    e = lambda arr, rel, to=lambda x: x: F.transform(arr, lambda x: F.struct(to(x).alias("target"), F.lit(rel).alias("relation")))
    category = lambda c: F.concat(F.lit("Category_"), F.replace(c, F.lit(" "), F.lit("_")))
    every = F.concat(e("members", "contains"), e("subcategories", "has_subcategory"), e("categories", "belongs_to", category), e("links", "wikilink"))
    out = pages.select(F.col("id").alias("source"), F.col("ord").alias("page_ord"), F.posexplode(every).alias("i", "e"))
    out = out.select("source", "e.target", "e.relation", "page_ord", "i")
    loop = F.col("source") == F.col("target")
    return out.where(~loop if self_loops == "none" else ~(loop & (F.col("relation") == "wikilink")))


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One row for each (source, target, relation), with the smallest ord."""
    return dealt(edges, "source", "target", "relation").groupBy("source", "target", "relation").agg(F.min("ord").alias("ord"))


def internal_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends are nodes."""
    # a semi-join would be moved to before the edges are dealt
    ids = dealt(nodes.select("id"), "id", like=edges).distinct()
    inner = dealt(edges, "source").join(ids.withColumnRenamed("id", "source"), "source")
    return dealt(inner, "target", like=edges).join(ids.withColumnRenamed("id", "target"), "target").select(*edges.columns)


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges with an end that is no node."""
    s = dealt(nodes.select(F.col("id").alias("source"), F.lit(True).alias("has_source")), "source", like=edges)
    t = dealt(nodes.select(F.col("id").alias("target"), F.lit(True).alias("has_target")), "target", like=edges)
    with_source = dealt(edges, "source").join(s, "source", "left")
    return dealt(with_source, "target", like=edges).join(t, "target", "left").where("has_source is null or has_target is null").select(*edges.columns)


# -- deduplicating nodes -----------------------------------------------------------


def title_key(id_: Column, title: Column) -> Column:
    """Normalised title; category and talk pages keep apart from plain ones."""
    t = F.lower(F.trim(title))
    t = F.regexp_replace(t, r"^category:\s*", "")
    t = F.trim(F.regexp_replace(F.replace(t, F.lit("_"), F.lit(" ")), r"\s+", " "))
    return F.concat(F.when(id_.startswith("Category_talk_"), "talk:").when(id_.startswith("Category_"), "cat:").otherwise(""), t)


def dedup_nodes(nodes: DataFrame) -> DataFrame:
    """One node for each title key: the one with the longest content, then most tags,
    then first. Of several, tags and aliases are united and sorted, all titles among the
    aliases; a single node stays as it is. Contents are compared by length, not collected."""
    n = nodes.withColumn("key", title_key(F.col("id"), F.col("title")))
    rank = F.struct(F.length("content").alias("a"), F.size("tags").alias("b"), (-F.col("ord")).alias("c"))
    best = n.groupBy("key").agg(
        F.max_by("id", rank).alias("id"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("tags")))).alias("all_tags"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.concat("aliases", F.array("title")))))).alias("names"),
        F.count("*").alias("n_merged"),
    )
    kept = n.drop("key").join(best, "id")
    alone = F.col("n_merged") == 1
    kept = kept.withColumn("tags", F.when(alone, F.col("tags")).otherwise(F.col("all_tags")))
    kept = kept.withColumn("aliases", F.when(alone, F.col("aliases")).otherwise(F.filter("names", lambda a: a != "")))
    return kept.drop("names", "all_tags")


def remap_table(nodes: DataFrame, kept: DataFrame) -> DataFrame:
    """old_id -> new_id for every node."""
    n = nodes.select(F.col("id").alias("old_id"), title_key(F.col("id"), F.col("title")).alias("key"))
    return n.join(kept.select("key", F.col("id").alias("new_id")), "key").select("old_id", "new_id")


def remap_edges(edges: DataFrame, table: DataFrame) -> DataFrame:
    """Ends replaced by their kept nodes; self-loops and repeats that result go."""
    s, t = table.toDF("source", "new_source"), table.toDF("target", "new_target")
    out = edges.join(s, "source", "left").join(t, "target", "left")
    out = out.select(F.coalesce("new_source", "source").alias("source"), F.coalesce("new_target", "target").alias("target"), "relation", "ord")
    return dedup_edges(out.where("source != target"))


# -- degrees and statistics --------------------------------------------------------


def _ends(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array(F.struct(F.col("source").alias("id"), F.lit(1).alias("out"), F.lit(0).alias("in")), F.struct(F.col("target").alias("id"), F.lit(0).alias("out"), F.lit(1).alias("in")))).alias("e")).select("e.*")


def degrees(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """``id, out_degree, in_degree, degree``; with ``nodes``, for each of them, zeros too."""
    d = _ends(edges).groupBy("id").agg(F.sum("out").alias("out_degree"), F.sum("in").alias("in_degree"))
    if nodes is not None:
        d = nodes.select("id").join(d, "id", "left").na.fill(0)
    return d.withColumn("degree", F.col("out_degree") + F.col("in_degree"))


def centrality(edges: DataFrame) -> DataFrame:
    """Degree over the largest degree."""
    d = degrees(edges).select("id", "degree")
    top = d.agg(F.max("degree").alias("top"))
    return d.crossJoin(F.broadcast(top)).select("id", F.round(F.col("degree") / F.col("top"), 9).alias("centrality"))  # one row


def hubs(edges: DataFrame, nodes: DataFrame, n: int = 30) -> DataFrame:
    """The nodes of highest degree, ties in node order."""
    d = degrees(internal_edges(edges, nodes))
    out = nodes.select("id", "title", "subtype", "ord").join(d, "id").orderBy(F.desc("degree"), "ord").limit(n)
    return out.select("id", "title", "subtype", "out_degree", "in_degree", "degree")


def relation_stats(edges: DataFrame) -> DataFrame:
    return edges.groupBy("relation").agg(F.count("*").alias("n_edges"), F.countDistinct("source").alias("n_sources"), F.countDistinct("target").alias("n_targets"))


def relation_tops(edges: DataFrame, end: str, n: int = 10) -> DataFrame:
    """For each relation the ends with most edges; ties by first appearance."""
    c = edges.groupBy("relation", end).agg(F.count("*").alias("n_edges"), F.min("ord").alias("first"))
    rank = F.row_number().over(Window.partitionBy("relation").orderBy(F.desc("n_edges"), "first", end))
    return c.withColumn("rank", rank).where(F.col("rank") <= n).select("relation", F.col(end).alias("id"), "n_edges", "rank")


def type_matrix(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges between each two subtypes as a dense grid with zeros."""
    s = nodes.select(F.col("id").alias("source"), F.col("subtype").alias("source_type"))
    t = nodes.select(F.col("id").alias("target"), F.col("subtype").alias("target_type"))
    wide = edges.join(s, "source").join(t, "target").groupBy("source_type").pivot("target_type", list(fixed.SUBTYPES)).count()
    spark = edges.sparkSession
    rows = spark.createDataFrame([(x,) for x in fixed.SUBTYPES], "source_type string")
    return rows.join(wide, "source_type", "left").na.fill(0)


def orphans(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes that no internal edge leads to."""
    hit = internal_edges(edges, nodes).select(F.col("target").alias("id"))
    return nodes.join(hit, "id", "left_anti").select("id", "title", "subtype")


def referrers(edges: DataFrame, nodes: DataFrame, n: int = 10, by_ord: bool = False) -> DataFrame:
    """For each page its top referring pages, with how many there are in all."""
    c = internal_edges(edges, nodes).groupBy("target", "source").agg(F.count("*").alias("n_links"), F.min("ord").alias("first"))
    every = c.groupBy("target").agg(F.count("*").alias("n_referrers"))
    rank = F.row_number().over(Window.partitionBy("target").orderBy(F.desc("n_links"), "first" if by_ord else "source", "source"))
    best = c.select("target", "source", "n_links", rank.alias("rank")).where(F.col("rank") <= n)
    return best.join(every, "target")


def first_links(edges: DataFrame, n: int | None = None) -> DataFrame:
    """The first edge from each page to each target, in order; at most ``n`` a page."""
    one = edges.groupBy("source", "target").agg(F.min_by("relation", "ord").alias("relation"), F.min("ord").alias("ord"))
    if n is None:
        return one
    rank = F.row_number().over(Window.partitionBy("source").orderBy("ord"))
    return one.withColumn("rank", rank).where(F.col("rank") <= n)


def count_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.desc("n"), column)


def neighbor_pairs(edges: DataFrame) -> DataFrame:
    """Distinct (id, neighbor) in both directions."""
    both = edges.select(F.col("source").alias("id"), F.col("target").alias("neighbor")).unionAll(edges.select("target", "source"))
    return dealt(both, "id", "neighbor", like=edges).distinct()


def neighbor_counts(edges: DataFrame) -> DataFrame:
    return neighbor_pairs(edges).groupBy("id").agg(F.count("*").alias("n_neighbors"))


def closure(edges: DataFrame, match: DataFrame) -> DataFrame:
    """The matched ids and all their direct neighbours."""
    m = match.select("id").distinct()
    return m.union(neighbor_pairs(edges).join(m, "id", "left_semi").select(F.col("neighbor").alias("id"))).distinct()


def tiered_match(nodes: DataFrame, query: str, few: int = 10) -> DataFrame:
    """Ids that match exactly, else by a part between underscores, else by content.

    A tier counts only if those before it are empty; contents only if they give
    at most ``few`` matches."""
    q = query.lower()
    name = F.lower("id")
    title = F.lower(F.replace("title", F.lit(" "), F.lit("_")))
    tier = (
        F.when((name == q) | (F.lower("title") == q), 1)
        .when(F.array_contains(F.split(name, "_"), q) | F.array_contains(F.split(title, "_"), q), 2)
        .when(F.lower("content").contains(q), 3)
    )
    m = nodes.select("id", tier.alias("tier")).where("tier is not null")
    best = m.groupBy().agg(F.min("tier").alias("tier"), F.count_if(F.col("tier") == 3).alias("n"))
    best = best.where((F.col("tier") < 3) | (F.col("n") <= few)).select("tier")
    return m.join(best, "tier").select("id", "tier")


def repaired_top(edges: DataFrame, nodes: DataFrame, n: int, most: int = 3) -> DataFrame:
    """The ``n`` nodes of highest degree, and the best structural neighbours of those
    among them that no structural edge links to the rest; ``most`` at most."""
    inner = internal_edges(edges, nodes)
    d = nodes.select("id", "ord").join(degrees(inner), "id", "left").na.fill(0)
    top = d.orderBy(F.desc("degree"), "ord").limit(n).select("id")
    pairs = neighbor_pairs(inner.where("relation != 'wikilink'"))
    joined = pairs.join(top, "id", "left_semi").join(top.withColumnRenamed("id", "neighbor").withColumn("inside", F.lit(True)), "neighbor", "left")
    alone = joined.groupBy("id").agg(F.count("inside").alias("k")).where("k = 0").select("id")
    cand = pairs.join(alone, "id").join(d.select(F.col("id").alias("neighbor"), "degree"), "neighbor")
    best = cand.groupBy("id").agg(F.max_by("neighbor", F.struct("degree", "neighbor")).alias("neighbor"), F.max("degree").alias("degree"))
    extra = best.groupBy("neighbor").agg(F.max("degree").alias("degree")).orderBy(F.desc("degree"), "neighbor").limit(most).select(F.col("neighbor").alias("id"))
    return top.withColumn("added", F.lit(False)).union(extra.withColumn("added", F.lit(True)))


def seed_scores(edges: DataFrame, probes: DataFrame, n: int = 5, default: tuple[str, ...] = ()) -> DataFrame:
    """Probe pages that contain other probes: those links less twice their other links to
    probes, ties by name descending; the default list if there are none."""
    p = probes.select("id").distinct()
    e = edges.join(p, edges.source == p.id, "left_semi").join(p, edges.target == p.id, "left_semi")
    has = F.count_if(F.col("relation") == "contains")
    s = e.groupBy(F.col("source").alias("id")).agg(has.alias("n_contains"), (has - 2 * F.count_if(F.col("relation") != "contains")).cast("long").alias("score"))
    s = s.where("n_contains > 0").select("id", "score").orderBy(F.desc("score"), F.desc("id")).limit(n)
    if not default:
        return s
    none = edges.sparkSession.createDataFrame([(x,) for x in default], "id string").withColumn("score", F.lit(None).cast("long"))
    found = s.agg(F.count("*").alias("k"))
    return s.unionAll(none.crossJoin(F.broadcast(found)).where("k = 0").select("id", "score"))  # one row


def lists_by(nodes: DataFrame, column: str, default: str = "Uncategorized") -> DataFrame:
    """Sizes and first and last id of each group; '' counts as the default."""
    g = F.coalesce(blank_to_null(F.col(column)), F.lit(default)).alias(column)
    return nodes.groupBy(g).agg(F.count("*").alias("n"), F.array_join(F.array_sort(F.collect_list("id")), " ").alias("ids"))
