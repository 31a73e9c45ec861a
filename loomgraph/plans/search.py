"""Ranked retrieval as relational plans over a positional inverted index.

All entry points take a batch of queries ``(qid, query)``: a batch is a small
table that joins the postings, and one query is a batch of one row.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.functions import fixed, terms
from loomgraph.operators import iterative
from loomgraph.plans import scan

K1, B = 1.5, 0.75
WINDOW, PROXIMITY = 30, 0.3
PRIMARY_TOP, EXPANDED_TOP, HOT_ZONE = 200, 100, 40


@dataclass
class Index:
    """Tables of a positional index. ``entries(id, ord, title, subtype, length, words, terms)`` has a row for each
    document with its stems and their positions, ``docs`` its first five columns; ``stems(stem, df, idf)``,
    ``vocabulary(word)``, ``corpus`` one row. ``postings(stem, id, tf, positions)`` are read off the entries."""

    entries: DataFrame
    docs: DataFrame
    stems: DataFrame
    vocabulary: DataFrame
    corpus: DataFrame
    k1: float = K1
    b: float = B
    extra: dict = field(default_factory=dict)

    TABLES = ("entries", "docs", "stems", "vocabulary", "corpus")

    @property
    def postings(self) -> DataFrame:
        t = self.entries.select("id", F.explode("terms").alias("t"))
        return t.select("t.stem", "id", F.size("t.positions").alias("tf"), "t.positions")

    def write(self, path: str) -> None:
        for t in self.TABLES:
            getattr(self, t).write.mode("overwrite").parquet(f"{path}/{t}")

    @classmethod
    def read(cls, spark: SparkSession, path: str) -> Index:
        return cls(*[spark.read.parquet(f"{path}/{t}") for t in cls.TABLES])


def positions(nodes: DataFrame) -> DataFrame:
    """``id, word, pos`` of every index token; positions count after stop words are dropped."""
    return nodes.select("id", F.posexplode(terms.index_tokens(F.col("title"), F.col("content"))).alias("pos", "word"))


def together(entries: DataFrame) -> DataFrame:
    """Entries in which rows that share an id are one document: its first row has the terms of all of them, the others none."""
    t = entries.select("id", F.explode("terms").alias("t")).groupBy("id", "t.stem").agg(F.array_sort(F.flatten(F.collect_list("t.positions"))).alias("positions"))
    t = t.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("stem", "positions"))).alias("terms")).withColumnRenamed("id", "one")
    first = F.row_number().over(Window.partitionBy("id").orderBy("ord", "title"))
    e = entries.select(*[c for c in entries.columns if c != "terms"]).withColumn("first", first)
    e = e.join(t, (F.col("first") == 1) & F.col("id").eqNullSafe(F.col("one")), "left")
    return e.select(*[F.coalesce("terms", F.array().cast(entries.schema["terms"].dataType)).alias(c) if c == "terms" else c for c in entries.columns])


def build(nodes: DataFrame, keep: Callable[[DataFrame], DataFrame] | None = None) -> Index:
    """Index of nodes(id, ord, title, content, subtype). A document is inverted by itself, without
    a shuffle. ``keep`` may write each table down, so that it is computed once for all uses."""
    put = keep or (lambda df: df)
    entries = scan.inverted(nodes)
    if not nodes.groupBy("id").count().where("count > 1").isEmpty():
        entries = together(entries)
    entries = put(entries)
    if keep:
        docs = entries.drop("words", "terms")
    else:  # not by way of the terms
        docs = nodes.select("id", "ord", "title", "subtype", F.size(terms.index_tokens(F.col("title"), F.col("content"))).alias("length"))
    corpus = put(docs.agg(F.count("*").alias("n"), (F.sum("length") / F.greatest(F.count("*"), F.lit(1))).alias("avgdl")))
    df = entries.select(F.explode("terms.stem").alias("stem")).groupBy("stem").agg(F.count("*").alias("df"))
    idf = F.log((F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5) + 1)
    stems = put(df.crossJoin(F.broadcast(corpus)).select("stem", "df", idf.alias("idf")))  # one row
    words = put(entries.select(F.explode("words").alias("word")).distinct())
    return Index(entries, docs, stems, words, corpus)


#: Words with at most so many letters after the first two meet by what is left of them without some letters, longer ones by pieces.
LONG = 24


def _marks(x: Column, k: int, asked: bool) -> Column:
    """Marks of which two strings at a distance of ``k`` at most have one in common, one of them ``asked``.

    Short ones have what is left without up to ``k`` characters. A long one is cut in
    ``k`` + 1 pieces, one of which is whole in the other, at most ``k`` places off.
    """
    n = F.length(x)
    none = F.array().cast("array<string>")
    less = lambda y: F.when(F.length(y) > 0, F.transform(F.sequence(F.lit(1), F.length(y)), lambda i: F.concat(F.left(y, i - 1), F.substring(y, i + 1, F.length(y))))).otherwise(none)
    left = F.concat(F.array(x), less(x))
    if k == 2:
        left = F.concat(left, F.flatten(F.transform(less(x), less)))
    mark = lambda s, m, i: F.struct(m.cast("int").alias("n"), i.cast("int").alias("i"), s.alias("s"))
    short = F.transform(F.array_distinct(left), lambda s: mark(s, F.lit(0), F.lit(0)))
    near = F.sequence(F.lit(-k), F.lit(k)) if asked else F.array(F.lit(0))

    def piece(m: Column, i: Column, off: Column) -> Column:
        lo, hi = F.floor(m * i / (k + 1)), F.floor(m * (i + 1) / (k + 1))
        return F.when((lo + off >= 0) & (hi + off <= n), mark(F.substring(x, (lo + off + 1).cast("int"), (hi - lo).cast("int")), m, i))

    pieces = F.transform(near, lambda by: F.flatten(F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: F.transform(near, lambda off: piece(n + by, i, off)))))
    long = F.array_distinct(F.array_compact(F.flatten(pieces)))
    if asked:
        return F.when(n <= LONG, short).otherwise(long)
    return F.when(n <= LONG - k, short).when(n <= LONG + k, F.concat(short, long)).otherwise(long)


def _within(odd: DataFrame, vocabulary: DataFrame, k: int) -> DataFrame:
    """``word, m``: of the words at a distance of ``k`` at most with the same first two letters, the least (d, c)."""
    split = lambda c: (F.left(c, F.lit(2)).alias("p"), F.substring(c, F.lit(3), F.length(c)).alias("end"))
    w = odd.select("word", *split(F.col("word")))
    sizes = w.select("p", F.explode(F.sequence(F.length("end") - k, F.length("end") + k)).alias("size")).distinct()
    v = vocabulary.select(F.col("word").alias("c"), *split(F.col("word"))).withColumn("size", F.length("end"))
    v = v.join(sizes, ["p", "size"], "left_semi")
    w = w.select("word", "p", F.explode(_marks(F.col("end"), k, True)).alias("mark"))
    v = v.select("c", "p", F.explode(_marks(F.col("end"), k, False)).alias("mark"))
    near = w.join(v, ["p", "mark"]).withColumn("d", F.levenshtein("word", "c", k)).where("d >= 0")
    return near.groupBy("word").agg(F.min(F.struct("d", "c")).alias("m"))


def corrections(index: Index, words: DataFrame) -> DataFrame:
    """``word, correction``: nearest vocabulary word with the same first two letters, by
    (distance, word), at a distance of two at most; only for unknown words of four letters.

    Words are compared only if they share a mark, first at a distance of one, and
    those that have none so near at a distance of two."""
    odd = words.select("word").distinct().where("length(word) >= 4")
    odd = odd.join(index.stems.select(F.col("stem").alias("word")), "word", "left_anti").join(index.vocabulary, "word", "left_anti")
    first = _within(odd, index.vocabulary, 1)
    second = _within(odd.join(first.select("word"), "word", "left_anti"), index.vocabulary, 2)
    return first.unionAll(second).select("word", F.col("m.c").alias("correction"), F.col("m.d").alias("distance"))


def query_stems(index: Index, queries: DataFrame, spelling: bool = True) -> DataFrame:
    """Distinct ``qid, stem`` of a batch, after spelling correction."""
    t = queries.select("qid", F.explode(terms.query_tokens(F.col("query"))).alias("word"))
    if spelling:
        own = index.stems.select(F.col("stem").alias("own"))
        stemmed = t.withColumn("stem", terms.stem(F.col("word")))
        unknown = stemmed.join(own, stemmed.stem == own.own, "left_anti").select("word")
        t = t.join(corrections(index, unknown), "word", "left").select("qid", F.coalesce("correction", "word").alias("word"))
    return t.select("qid", terms.stem(F.col("word")).alias("stem")).distinct()


def bm25(index: Index, queries: DataFrame, limit: int | None = PRIMARY_TOP, spelling: bool = True, proximity: float = PROXIMITY, window: int = WINDOW) -> DataFrame:
    """``qid, id, score, n_near, rank``: best documents of each query, ties in document order."""
    return bm25_runs(index, queries, [scan.Run(index.k1, index.b, window, proximity)], limit, spelling).drop("run")


def bm25_runs(index: Index, queries: DataFrame, runs: list[scan.Run], limit: int | None = PRIMARY_TOP, spelling: bool = True) -> DataFrame:
    """``run, qid, id, ord, score, n_near, rank`` of several settings in one pass over the entries.

    The batch's stems go to every task. A task scores its documents for all queries and
    hands on those only that may be among the best, so what is shuffled does not grow with the hits."""
    q = query_stems(index, queries, spelling).join(index.stems, "stem").select("qid", "stem", "idf")
    batch = scan.Batch([tuple(r) for r in q.collect()], index.corpus.first()["avgdl"] or 1.0, tuple(runs), limit)
    s = scan.scored(index.entries, batch)
    factor = F.element_at(F.array(*[F.lit(float(r.proximity)) for r in runs]), F.col("run") + 1)
    s = s.withColumn("score", F.round(F.when(F.col("n_near") >= 2, F.col("raw") * (1 + factor * (F.col("n_near") - 1))).otherwise(F.col("raw")), 9))
    return top(s.select("run", "qid", "id", "ord", "score", "n_near"), limit, by=("run", "qid"))


def top(scored: DataFrame, limit: int | None, score: str = "score", by: tuple[str, ...] = ("qid",)) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc(score), "ord"))
    out = scored.withColumn("rank", rank)
    return out if limit is None else out.where(F.col("rank") <= limit)


@dataclass(frozen=True)
class Weights:
    """Constants of the ranking; the defaults are those of ``search``."""

    neighbor: float = 0.3
    graph: float = 0.6
    shares: tuple[float, float] | None = None
    types: tuple[tuple[str, float], ...] = tuple(fixed.TYPE_BOOST.items())
    title: float | None = 1.5
    hub_titles: tuple[str, ...] = fixed.HUB_TITLES
    same_type: float = 1.2
    fallback: bool = True


def fused(index: Index, queries: DataFrame, weights: Weights = Weights(), keep: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """``qid, id, score``: the query's scores and those of up to nine expansions, each over its own maximum."""
    kinds = query_kinds(index, queries, weights)
    w = Window.partitionBy("qid")
    more = queries.select("qid", F.posexplode(F.slice(terms.expand(F.col("query")), 2, 9)).alias("i", "term"))
    sub = more.select(F.concat_ws("\x1f", "qid", F.col("i").cast("string")).alias("qid"), F.col("term").alias("query"))
    # the query and its expansions are one batch
    every = bm25(index, queries.select("qid", "query").unionAll(sub), PRIMARY_TOP).withColumn("part", F.col("score") / F.max("score").over(w))
    every = keep(every.withColumn("own", ~F.contains("qid", F.lit("\x1f"))).where(F.col("own") | (F.col("rank") <= EXPANDED_TOP)))
    first = every.where("own").join(kinds, "qid").select("qid", "id", "ord", (F.col("part") * F.col("w_own")).alias("part"))
    second = every.where("not own").withColumn("qid", F.substring_index("qid", "\x1f", 1))
    second = second.join(kinds, "qid").select("qid", "id", "ord", (F.col("part") * F.col("w_more")).alias("part"))
    # without a hit of the query itself there is no ranking
    second = second.join(first.select("qid").distinct(), "qid", "left_semi")
    return first.unionAll(second).groupBy("qid", "id", "ord").agg(F.round(F.sum("part"), 9).alias("score"))


def query_kinds(index: Index, queries: DataFrame, weights: Weights = Weights()) -> DataFrame:
    """``qid, avg_idf, exact, w_own, w_more``: how far to trust a query or its expansions."""
    t = queries.select("qid", F.explode_outer(terms.query_tokens(F.col("query"))).alias("word"))
    t = t.join(index.stems.select(F.col("stem").alias("word"), "idf"), "word", "left")
    names = index.docs.where("subtype = 'parameter'").select(F.col("id").alias("name"), F.lit(True).alias("is_name"))
    t = t.join(names, F.upper("word") == F.col("name"), "left")
    k = t.groupBy("qid").agg(F.coalesce(F.avg(F.when(F.col("word").isNotNull(), F.coalesce("idf", F.lit(1.0)))), F.lit(0.0)).alias("avg_idf"), F.coalesce(F.bool_or("is_name"), F.lit(False)).alias("exact"), F.count("word").alias("n"))
    if weights.shares:
        return k.select("qid", "avg_idf", "exact", F.lit(weights.shares[0]).alias("w_own"), F.lit(weights.shares[1]).alias("w_more"))
    sure, broad = F.col("exact") | (F.col("avg_idf") > 4.0), (F.col("n") == 1) & (F.col("avg_idf") < 2.5)
    return k.select("qid", "avg_idf", "exact", F.when(sure, 4.0).when(broad, 1.5).otherwise(2.0).alias("w_own"), F.when(sure, 0.5).when(broad, 2.0).otherwise(1.5).alias("w_more"))


def neighbor_votes(scored: DataFrame, pairs: DataFrame, zone: int = HOT_ZONE) -> DataFrame:
    """``qid, id, votes``: neighbours among the ``zone`` best of the query."""
    hot = top(scored, zone).select("qid", F.col("id").alias("neighbor"))
    return hot.join(pairs, "neighbor").join(scored.select("qid", "id"), ["qid", "id"]).groupBy("qid", "id").agg(F.count("*").alias("votes"))


def search(index: Index, queries: DataFrame, pairs: DataFrame, ranks: DataFrame, limit: int = 10, subtype: str | None = None, weights: Weights = Weights(), keep: Callable[[DataFrame], DataFrame] = iterative.stored) -> DataFrame:
    """``qid, rank, id, title, subtype, score``: fused scores, boosted by neighbours, PageRank,
    type and title. A query without hits falls back to the top pages by PageRank, of all types.
    Candidates, at most some hundred a query, are written down by ``keep``, as several steps read them."""
    docs = index.docs.select("id", "ord", "title", "subtype")
    s = keep(fused(index, queries, weights, keep).join(docs.drop("ord"), "id"))
    lead = top(s, 1).select("qid", F.col("subtype").alias("lead"))
    votes = neighbor_votes(s.select("qid", "id", "ord", "score"), pairs)
    t = queries.select("qid", F.explode(terms.query_tokens(F.col("query"))).alias("word"))
    rare = t.join(index.stems.where("idf > 2.0").select(F.col("stem").alias("word")), "word", "left_semi").groupBy("qid").agg(F.collect_set("word").alias("rare"))
    s = s.join(lead, "qid").join(votes, ["qid", "id"], "left").join(ranks.select("id", F.col("score").alias("pr")), "id", "left").join(rare, "qid", "left")
    low = F.lower("title")
    in_title = F.exists("rare", lambda w: low.contains(w) | F.replace(low, F.lit("_"), F.lit(" ")).contains(w))
    nb = 1 + weights.neighbor * F.coalesce("votes", F.lit(0))
    nb = F.when((F.col("lead") == "parameter") & F.col("title").isin(*weights.hub_titles), nb * 0.5).otherwise(nb)
    kind = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in weights.types for x in kv]), F.coalesce("subtype", F.lit("generic"))), F.lit(1.0))
    same = F.when((F.col("lead") == F.col("subtype")) & F.col("lead").isin("parameter", "tutorial"), weights.same_type).otherwise(1.0)
    title = F.when(F.coalesce(in_title, F.lit(False)), weights.title or 1.0).otherwise(1.0)
    final = F.col("score") * nb * (1 + weights.graph * F.sqrt(F.coalesce("pr", F.lit(0.0)))) * kind * same * title
    s = s.select("qid", "id", "ord", "title", "subtype", F.round(final, 6).alias("score"))
    shown = s if subtype is None else s.where(F.col("subtype") == subtype)
    out = top(shown, limit).select("qid", "rank", "id", "title", "subtype", "score")
    if not weights.fallback:
        return out
    none = queries.select("qid").join(s.select("qid").distinct(), "qid", "left_anti")
    best = fallback(docs, ranks, limit)
    return out.unionByName(none.crossJoin(F.broadcast(best)))  # `limit` rows


def fallback(docs: DataFrame, ranks: DataFrame, limit: int = 10) -> DataFrame:
    """The top pages of docs(id, ord, title, subtype) by PageRank, in document order where equal."""
    d = docs.join(ranks.select("id", F.col("score").alias("pr")), "id", "left").na.fill(0.0, ["pr"])
    best = d.orderBy(F.desc("pr"), "ord").limit(limit)
    rank = F.row_number().over(Window.orderBy(F.desc("pr"), "ord"))  # over `limit` rows
    return best.select(rank.alias("rank"), "id", "title", "subtype", F.round("pr", 6).alias("score"))


def precision(results: DataFrame, golden: DataFrame, k: int = 5) -> DataFrame:
    """``qid, hits, precision``: expected titles among the first ``k`` results, over ``k``."""
    want = golden.select("qid", F.explode(F.array_distinct("expected")).alias("title"))
    hit = results.where(F.col("rank") <= k).join(want, ["qid", "title"], "left_semi").groupBy("qid").agg(F.count("*").alias("hits"))
    return golden.select("qid").join(hit, "qid", "left").na.fill(0).select("qid", "hits", (F.col("hits") / k).alias("precision"))


def best_of(runs: DataFrame) -> DataFrame:
    """The first configuration of the highest mean precision; runs(config, ord, qid, precision)."""
    m = runs.groupBy("config", "ord").agg(F.round(F.avg("precision"), 9).alias("mean"))
    return m.groupBy().agg(F.max_by("config", F.struct("mean", -F.col("ord"))).alias("config"), F.max("mean").alias("mean"))
