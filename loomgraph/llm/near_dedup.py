"""Operator 2: near-duplicate documents by an LSH forest over MinHash signatures.

A signature has ``TREES * STEP`` minima of a document's 5-word shingles. Tree
``t`` sorts documents by the signature rotated to start at ``t * STEP``. A region
of a tree is a run of documents that have the first ``STEP`` minima in common;
within it the sorted order puts those with the longest common prefix next to
each other, so that the depth at which neighbours part adapts to the region: the
more crowded it is, the longer the prefixes that neighbours share. Each document
is compared with the ``NEAR`` ones before and after it in every order, which in
regions of up to ``NEAR + 1`` members is each with every other. The most alike
partners of each document come first: what they link needs no more links, so of the
other pairs only those of different components are confirmed.

Regions that hold more members than that, and whose members are then in more
than one component, are cut into blocks, and all pairs of members of different
components are compared on their sketches and then on the ``LOW`` least shingles of
their sets, which for shorter documents are the sets themselves, so no link between
components is lost and few other pairs leave a block.

Documents with equal shingle sets form one class before the search, so exact
copies cost nothing. Candidates whose signatures cannot come from sets as
similar as asked (more than five standard deviations below) are left out; the
others are confirmed on full shingle sets. Connected components of the
confirmed links are computed by distributed star contraction.

Orders are dealt by ranges: small regions stay whole, a crowded one may span
any number of tasks, so a region that holds a third of all rows is no hot task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loomgraph.llm._shared import U64, Stash, components, documents, groups, mix, partitions, shingle_set, with_texts

TREES, STEP = 24, 4
#: Neighbours of a document on either side of it in an order.
NEAR = 16
#: So many most alike partners of each class are confirmed in each round; the last one takes all that are left.
#: After the first, pairs that meet in crowded regions only are left to the comparison of all their members.
ROUNDS = (2, 8, None)
#: A region with more members may be dealt to several tasks.
WHOLE = 4096
PERCENT = 75
#: Members of a block of a crowded region.
BLOCK = 512
#: Partners of a member in a block that are tried before all others.
BEST = 8
#: So many least shingle hashes of a member of a crowded region are kept; a set of fewer is kept whole.
LOW = 512

_RNG = np.random.default_rng(20240229)
_MULT = _RNG.integers(1, 2**32, TREES * STEP, dtype=np.uint64) * U64(2) + U64(1)
_ADD = _RNG.integers(0, 2**63, TREES * STEP, dtype=np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Upper 32 bits of the minimum of each hash function over the set."""
    out = np.full(TREES * STEP, np.iinfo(np.uint64).max, dtype=U64)
    for at in range(0, len(shingles), 512):
        part = shingles[at : at + 512, None]
        out = np.minimum(out, (part * _MULT + _ADD).min(axis=0))
    return (out >> U64(32)).astype(np.uint32)


def class_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


FEATURES = pa.schema([("doc_id", pa.int64()), ("row", pa.int64()), ("n_shingles", pa.int64()), ("cls", pa.int64()), ("sig", pa.list_(pa.int32())), ("sketch", pa.binary())])


def _features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in it:
        for at in range(0, big.num_rows, 500):
            b = big.slice(at, 500)
            n, cls, sig, sketch = [], [], [], []
            for text in b.column(2).to_pylist():
                s = shingle_set(text)
                n.append(len(s))
                if len(s):
                    g = signature(s)
                    cls.append(class_of(s))
                    sig.append(g.view(np.int32))
                    sketch.append(mix(g.astype(U64)).astype(np.uint8).tobytes())
                else:
                    cls.append(None)
                    sig.append(None)
                    sketch.append(None)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(sig, FEATURES.field("sig").type), pa.array(sketch, pa.binary())], schema=FEATURES)


def row_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, row, n_shingles, cls, sig, sketch``; null class for documents without words.

    ``row`` tells rows with null or repeated doc_id apart by their text.
    """
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_hash(text).alias("row"), text.alias("text")).mapInArrow(_features, "doc_id long, row long, n_shingles long, cls long, sig array<int>, sketch binary")


def orders(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``region, n, order, cls`` of all regions with two members or more, and ``region, n, cls`` of crowded ones.

    ``order`` is the sketch from the region's minima on, around the end.
    """
    place = F.col("t") * STEP
    region = F.xxhash64("t", F.slice("sig", place + 1, STEP)).alias("region")
    rows = classes.select("cls", "sig", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("t")).select(region, "cls", "t")
    shared = rows.groupBy("region").agg(F.count("*").alias("n")).where("n > 1")
    here = rows.join(shared, "region")
    turned = F.concat(F.expr(f"substring(sketch, t * {STEP} + 1)"), F.expr(f"substring(sketch, 1, t * {STEP})")).alias("order")
    return here.join(classes.select("cls", "sketch"), "cls").select("region", "n", turned, "cls"), here.where(F.col("n") > NEAR + 1).select("region", "n", "cls")


def _neighbours(need: float):
    """Sorted rows ``region, order, cls, n`` -> likely pairs of neighbours ``a < b``, in how many places their
    sketches agree, and whether the region is small, so that its members all meet."""
    width = TREES * STEP

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        region, cls, sk = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, width), np.uint8)
        small = np.zeros(0, bool)
        for big in it:
            for at in range(0, big.num_rows, 4000):
                b = big.slice(at, 4000)
                held = len(cls)
                region = np.concatenate((region, b.column(0).to_numpy()))
                cls = np.concatenate((cls, b.column(2).to_numpy()))
                sk = np.concatenate((sk, np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(-1, width)))
                small = np.concatenate((small, b.column(3).to_numpy() <= NEAR + 1))
                left, right, alike, met = [], [], [], []
                for step in range(1, min(NEAR, len(cls) - 1) + 1):
                    j = np.arange(max(held, step), len(cls))
                    j = j[region[j] == region[j - step]]
                    same = (sk[j] == sk[j - step]).sum(axis=1)
                    j, same = j[same >= need], same[same >= need]
                    left.append(cls[j - step])
                    right.append(cls[j])
                    alike.append(same.astype(np.int32))
                    met.append(small[j])
                if left and len(x := np.concatenate(left)):
                    y = np.concatenate(right)
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(np.concatenate(alike)), pa.array(np.concatenate(met))], names=["a", "b", "same", "small"])
                region, cls, sk, small = region[-NEAR:], cls[-NEAR:], sk[-NEAR:], small[-NEAR:]

    return run


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Likely pairs ``a < b`` of classes near each other in some order, in how many places they agree, and whether some small region has both."""
    part = F.when(F.col("n") > WHOLE, F.concat("order", F.col("cls").cast("string").cast("binary"))).otherwise(F.lit(b""))
    rows = rows.withColumn("part", part).repartitionByRange(partitions(rows.sparkSession), "region", "part")
    rows = rows.select("region", "order", "cls", "n").sortWithinPartitions("region", "order", "cls")
    return rows.mapInArrow(_neighbours(_need(percent / 100)), "a long, b long, same int, small boolean").groupBy("a", "b").agg(F.max("same").alias("same"), F.max("small").alias("small"))


def _need(least: float) -> float:
    """In how many places signatures must agree."""
    width = TREES * STEP
    sd = (least * (1 - least) / width) ** 0.5
    return (least - 5.2 * sd) * width


def _lowest(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``cls, text`` -> the ``LOW`` least shingle hashes, in order."""
    for big in it:
        for at in range(0, big.num_rows, 500):
            b = big.slice(at, 500)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([shingle_set(t)[:LOW].tobytes() for t in b.column(1).to_pylist()], pa.binary())], names=["cls", "low"])


def may_link(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets can be as similar as asked, by their ``LOW`` least items; exact for sets of fewer.

    The least items of the union are a random sample of it; five standard deviations are allowed for.
    """
    both = np.intersect1d(x, y, assume_unique=True)
    if len(x) < LOW and len(y) < LOW:
        return 100 * len(both) >= percent * (len(x) + len(y) - len(both))
    least = percent / 100
    edge = np.union1d(x, y)[LOW - 1]
    return np.searchsorted(both, edge, "right") >= (least - 5.2 * (least * (1 - least) / LOW) ** 0.5) * LOW


def _across(need: float, best: int | None, percent: int):
    """Rows ``region, bi, bj, blk, cls, component, sketch, low``, sorted -> likely pairs of two components."""
    width = TREES * STEP

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in groups(it, [0, 1, 2]):
            blk, cls, comp = (t.column(k).to_numpy() for k in (3, 4, 5))
            sk = np.frombuffer(b"".join(t.column(6).to_pylist()), np.uint8).reshape(-1, width)
            low = [np.frombuffer(x, U64) for x in t.column(7).to_pylist()]
            bi, bj = t.column(1)[0].as_py(), t.column(2)[0].as_py()
            left, right = np.flatnonzero(blk == bi), np.flatnonzero(blk == bj)
            for i in left.tolist():
                # a pair within a block is met once, but each member has its own best ones
                j = right[comp[right] != comp[i]]
                if best is None and bi == bj:
                    j = j[j > i]
                same = (sk[j] == sk[i]).sum(axis=1)
                j, same = j[same >= need], same[same >= need]
                if best is not None and len(j) > best:
                    j = j[np.argpartition(-same, best)[:best]]
                j = j[np.fromiter((may_link(low[i], low[k], percent) for k in j.tolist()), bool, len(j))]
                if len(j):
                    a, b = np.minimum(cls[i], cls[j]), np.maximum(cls[i], cls[j])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def across(stash: Stash, docs: DataFrame, crowded: DataFrame, classes: DataFrame, joined: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Likely pairs ``a < b`` of different components within crowded regions: all, or ``best`` a member and block.

    Regions of one component have none, however large they are.
    """
    spark = crowded.sparkSession
    rows = crowded.join(joined.select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    mixed = rows.groupBy("region").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("region")
    rows = rows.join(mixed, "region").withColumn("nb", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    rows = stash.put(rows, "mixed")
    low = _texts(docs, classes, rows.select("cls").distinct()).mapInArrow(_lowest, "cls long, low binary")
    kept = classes.select("cls", "sketch").join(low, "cls")
    other = F.explode(F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(F.least(o, F.col("blk")).alias("bi"), F.greatest(o, F.col("blk")).alias("bj"))))
    rows = rows.select("region", "blk", "cls", "component", other.alias("p")).join(kept, "cls").select("region", "p.bi", "p.bj", "blk", "cls", "component", "sketch", "low")
    rows = rows.repartition(partitions(spark), "region", "bi", "bj").sortWithinPartitions("region", "bi", "bj", "cls")
    return stash.put(rows.mapInArrow(_across(_need(percent / 100), best, percent), "a long, b long").distinct(), "across")


def _confirm(percent: int):
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, np.ndarray] = {}

        def of(key: int, text: str) -> np.ndarray:
            if key not in known:
                if len(known) >= 64:
                    known.clear()
                known[key] = shingle_set(text)
            return known[key]

        for b in it:
            ok = []
            for a, c, ta, tb in zip(*(b.column(i).to_pylist() for i in range(4))):
                x, y = of(a, ta), of(c, tb)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    return run


def _texts(docs: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """``cls, text`` of the classes in ``needed``: the text of the row that stands for each."""
    needed = needed.join(classes.select("cls", *ROW), "cls")
    text = F.col("text").cast("string")
    return docs.select(*row_key(F.col("doc_id").cast("long"), row_hash(text)), text.alias("text")).join(needed, list(ROW)).select("cls", "text").dropDuplicates(["cls"])


def _confirmed(stash: Stash, docs: DataFrame, classes: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` whose full shingle sets are as similar as asked."""
    needed = pairs.select(F.col("a").alias("cls")).unionAll(pairs.select("b")).distinct()
    texts = stash.put(_texts(docs, classes, needed), "texts")
    links = with_texts(pairs, texts, "cls").select("a", "b", "text_a", "text_b").mapInArrow(_confirm(percent), "a long, b long")
    links = stash.put(links.distinct(), "links")
    stash.drop(texts)
    return links


def _best(pairs: DataFrame, n: int) -> DataFrame:
    """Pairs ``a, b`` in which one is among the other's ``n`` most alike; a class has at most ``2 * NEAR * TREES``."""
    both = pairs.select(F.col("a").alias("v"), "same", "a", "b").unionAll(pairs.select(F.col("b").alias("v"), "same", "a", "b"))
    rank = F.row_number().over(Window.partitionBy("v").orderBy(F.desc("same"), "a", "b"))
    return both.withColumn("rank", rank).where(F.col("rank") <= n).select("a", "b").distinct()


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose ends are in different components."""
    of = lambda c: joined.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}"))
    rows = pairs.join(of("a"), "a", "left").join(of("b"), "b", "left")
    return rows.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b", "same", "small")


def _linked(stash: Stash, docs: DataFrame, classes: DataFrame, pairs: DataFrame, joined: DataFrame, percent: int) -> DataFrame:
    """Components after the links among ``pairs``; those ``joined`` so far count as stars, not by all their links."""
    if pairs.isEmpty():
        return joined
    stars = joined.where("node != component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return components(stash, stars.unionAll(_confirmed(stash, docs, classes, pairs, percent)))


#: What tells one row from another: its text, and its doc_id, null or not.
ROW = ("row", "no_id", "id")


def row_key(doc_id: Column, row: Column) -> list[Column]:
    return [row.alias("row"), doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id")]


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, row, grp`` for every row of ``docs``.

    Null or empty texts and texts without words have an empty set and are
    linked with nothing (``grp`` is null). Rows with equal sets are one class
    whatever their doc_id; rows that repeat a doc_id with another text are
    documents of their own. A null doc_id never names a component: such a row
    gets the smallest doc_id it is linked to, or null if there is none, and is
    kept only in the latter case. ``grp`` names the group also of those. Other
    columns are ignored. An empty table gives no rows.
    """
    stash = Stash(docs.sparkSession, "near-dedup")
    feats = stash.put(features(docs), "features")
    # of each class the first row stands for all, whatever order rows come in
    keyed = feats.where("cls is not null").select("cls", "doc_id", *row_key(F.col("doc_id"), F.col("row")))
    first = keyed.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.min(F.struct("no_id", "id", "row")).alias("r"), F.count("*").alias("copies"))
    first = stash.put(first.select("cls", "rep", "copies", *(F.col(f"r.{c}") for c in ROW)), "classes")
    classes = feats.select("cls", "sig", "sketch", *row_key(F.col("doc_id"), F.col("row"))).join(first.select("cls", "rep", *ROW), ["cls", *ROW]).dropDuplicates(["cls"])
    classes = stash.put(classes, "signatures")
    rows, crowded = orders(classes)
    pairs = stash.put(candidates(rows, percent), "likely")
    crowded = stash.put(crowded, "crowded")
    joined, tried = None, None
    for best in ROUNDS:
        if joined is not None:
            pairs = stash.put(_apart(pairs.where("small").join(tried, ["a", "b"], "left_anti"), joined), "apart")
        tried = pairs.select("a", "b") if best is None else stash.put(_best(pairs, best), "best")
        joined = components(stash, _confirmed(stash, docs, classes, tried, percent)) if joined is None else _linked(stash, docs, classes, tried, joined, percent)
    # the nearest ones of other components first, which leaves few for the pass over all
    for best in (BEST, None) if not crowded.isEmpty() else ():
        pairs = across(stash, docs, crowded, classes, joined, percent, best)
        joined = _linked(stash, docs, classes, pairs, joined, percent)
    named = joined.join(first.select("cls", "rep"), joined.node == F.col("cls")).select("cls", "rep", "component")
    smallest = named.groupBy("component").agg(F.min("rep").alias("smallest"))
    named = named.join(smallest, "component").select("cls", "smallest", "component")
    label = first.where("copies > 1").select("cls", "rep").join(named, "cls", "full_outer").select("cls", F.coalesce("smallest", "rep").alias("component_id"), "component")
    label = stash.put(label, "labels")
    stash.keep(feats, label)
    out = feats.select("doc_id", "row", "n_shingles", "cls").join(label, "cls", "left")
    out = out.select("doc_id", "row", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("component", "cls").alias("grp"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each group of copies and near copies, all columns as they are.

    It is the row with the smallest doc_id, nulls last, ties by a hash of the
    text; of rows that repeat both, one stays. Rows without words are in no
    group and stay.
    """
    found = near_duplicates(docs, percent).where("grp is not null").select("grp", *row_key(F.col("doc_id"), F.col("row")))
    found = Stash(docs.sparkSession, "near-rows").put(found.groupBy("grp", *ROW).agg(F.count("*").alias("times")), "rows")
    best = found.groupBy("grp").agg(F.min(F.struct("no_id", "id", "row")).alias("r"))
    other = found.join(best, "grp").where(F.struct("no_id", "id", "row") != F.col("r")).select(*ROW)
    names = [f"_loom_{c}" for c in ROW]
    keyed = docs.select("*", *(c.alias(n) for c, n in zip(row_key(F.col("doc_id").cast("long"), row_hash(F.col("text").cast("string"))), names)))
    out = keyed.join(other.toDF(*names), names, "left_anti")
    twice = found.where("times > 1").select(*ROW).toDF(*names)
    if not twice.isEmpty():
        out = out.join(twice, names, "left_anti").unionByName(out.join(twice, names, "left_semi").dropDuplicates(names))
    return out.drop(*names)


def op2_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets have a Jaccard similarity of 0.75 or more."""
    return near_duplicates(documents(spark, sf_dir)).drop("row", "grp")
