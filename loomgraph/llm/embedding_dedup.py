"""Operator 7: near-duplicate embeddings by Euclidean p-stable hashing.

A normalised vector falls, in each of ``TABLES`` tables, into the bucket of
``PROJECTIONS`` Gaussian projections, shifted by a random offset and quantised
to steps of ``WIDTH``. Vectors that share a bucket in some table are compared by
exact cosine in double precision, in blocks of matrix products. For a cosine of
0.95 (distance 0.316) a projection agrees with probability 0.874, so a pair at
the very threshold is missed with probability 1.2e-3, one at 0.97 with 2e-6.

Equal vectors form one class first and are compared once, with their number as
weight. A bucket with the same members as one of an earlier table adds nothing
and is left out, so near copies of one vector, which share most tables, are
moved about once. A crowded bucket is split into blocks of ``BLOCK`` vectors and
each pair of blocks is a group of its own, so no task sees more than two blocks.
A pair counts only in the first table whose bucket it shares, which is told from
the bucket numbers of the two vectors, computed again where they are met. Blocks
return counts and the links of a spanning forest, never their pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import Merge, Stash, components, groups, mix, partitions

TABLES, PROJECTIONS, WIDTH = 96, 20, 2.0
BLOCK = 512
COSINE = 0.95


def _hash_tables(dim: int, seed: int = 99) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim])
    return rng.standard_normal((dim, TABLES * PROJECTIONS)), rng.random(TABLES * PROJECTIONS) * WIDTH


def buckets(x: np.ndarray) -> np.ndarray:
    """Bucket of each row of unit vectors in each table, as 64-bit hashes."""
    a, b = _cached(x.shape[1])
    q = np.floor((x @ a + b) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(x), TABLES, PROJECTIONS)
    # vectors of different lengths share no bucket
    h = mix(np.zeros((len(x), TABLES), np.uint64) + np.arange(TABLES, dtype=np.uint64) + np.uint64(x.shape[1] << 20))
    for i in range(PROJECTIONS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + q[:, :, i])
    return h


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _cached(dim: int):
    if dim not in _TABLES:
        _TABLES[dim] = _hash_tables(dim)
    return _TABLES[dim]


def clean(v: list | None) -> np.ndarray | None:
    """The unit vector in double precision; None if it links with nothing."""
    if v is None or not len(v) or any(c is None for c in v):
        return None
    x = np.array(v, float)
    if not np.isfinite(x).all():
        return None
    top = np.abs(x).max()
    if top == 0:
        return None
    x = x / top
    return x / np.sqrt(x @ x)


def _features(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, class of equal vectors, unit vector, bucket of each table."""
    for big in it:
        for at in range(0, big.num_rows, 1000):
            b = big.slice(at, 1000)
            units = [clean(v) for v in b.column(1).to_pylist()]
            cls: list = [None] * len(units)
            raw: list = [None] * len(units)
            keys: list = [None] * len(units)
            by_dim: dict[int, list[int]] = {}
            for i, u in enumerate(units):
                if u is not None:
                    by_dim.setdefault(len(u), []).append(i)
                    raw[i] = u.tobytes()
                    cls[i] = xxhash.xxh3_64_intdigest(raw[i]) - 2**63
            for own in by_dim.values():
                h = buckets(np.stack([units[i] for i in own]))
                for i, row in zip(own, h.view(np.int64)):
                    keys[i] = row
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cls, pa.int64()), pa.array(raw, pa.binary()), pa.array(keys, pa.list_(pa.int64()))], names=["vec_id", "cls", "unit", "keys"])


def _compare(cosine: float):
    """Groups of a bucket's block pair -> (cls, links, edge to another class)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cls, links, to = [], [], []
        for g in groups(it, [0, 1, 2, 3]):
            if g.num_rows < 2:
                continue
            t, bi, bj = (g.column(i)[0].as_py() for i in (1, 2, 3))
            blk = g.column("blk").to_numpy()
            c = g.column("cls").to_numpy()
            w = g.column("copies").to_numpy()
            units = g.column("unit").to_pylist()
            x = np.frombuffer(b"".join(units), float).reshape(len(c), -1)
            left = np.flatnonzero(blk == bi)
            right = np.flatnonzero(blk == bj)
            hit = x[left] @ x[right].T >= cosine
            if bi == bj:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            if not len(i):
                continue
            i, j = left[i], right[j]
            if t:
                own, at = np.unique(np.concatenate((i, j)), return_inverse=True)
                keys = buckets(x[own])[:, :t]
                i, j = at[: len(i)], at[len(i) :]
                fresh = np.ones(len(i), bool)
                for at in range(0, len(i), 4096):
                    s = slice(at, at + 4096)
                    fresh[s] = ~(keys[i[s]] == keys[j[s]]).any(axis=1)
                i, j = own[i[fresh]], own[j[fresh]]
                if not len(i):
                    continue
            n = np.bincount(i, w[j], len(c)) + np.bincount(j, w[i], len(c))
            m = Merge()
            for a, b in zip(c[i].tolist(), c[j].tolist()):
                m.union(a, b)
            for k in np.flatnonzero(n).tolist():
                cls.append(int(c[k]))
                links.append(int(n[k]))
                to.append(m.find(int(c[k])))
            if len(cls) >= 20000:
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(links, pa.int64()), pa.array(to, pa.int64())], names=["cls", "links", "to"])
                cls, links, to = [], [], []
        if cls:
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(links, pa.int64()), pa.array(to, pa.int64())], names=["cls", "links", "to"])

    return run


def near_vectors(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Null, empty and zero vectors and those with null or non-finite components
    link with nothing. Equal vectors link with one another. Vectors of different
    lengths are never linked. A null vec_id names no component; rows that repeat
    a vec_id count as vectors of their own. Other columns are ignored. An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    stash = Stash(spark, "near-vectors")
    v = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e"))
    feats = stash.put(v.mapInArrow(_features, "vec_id long, cls long, unit binary, keys array<long>"), "features")
    classes = feats.where("cls is not null").groupBy("cls").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
    classes = stash.put(classes, "classes")
    one = feats.join(classes, "cls").where(F.col("vec_id").eqNullSafe(F.col("rep"))).select("cls", "unit", "keys", "copies").dropDuplicates(["cls"])
    one = stash.put(one, "vectors")
    rows = one.select("cls", F.posexplode("keys").alias("t", "bucket"))
    crowds = rows.groupBy("bucket", "t").agg(F.count("*").alias("n"), *(F.sum(F.xxhash64(F.lit(i), "cls").cast("decimal(38,0)")).alias(f"s{i}") for i in (1, 2))).where("n > 1")
    # buckets with the same members: the one of the first table stands for all
    crowds = crowds.groupBy("n", "s1", "s2").agg(F.min(F.struct("t", "bucket")).alias("m")).select("m.bucket", "m.t", "n")
    rows = rows.join(crowds, ["bucket", "t"])
    n_blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    rows = rows.withColumn("nb", n_blocks).withColumn("blk", F.pmod(F.xxhash64("cls"), F.col("nb")).cast("int"))
    other = F.explode(F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda o: F.struct(F.least(o, F.col("blk")).alias("bi"), F.greatest(o, F.col("blk")).alias("bj"))))
    rows = rows.select("bucket", F.col("t").cast("int").alias("t"), "cls", "blk", other.alias("p"))
    rows = rows.join(one.select("cls", "copies", "unit"), "cls").select("bucket", "t", "p.bi", "p.bj", "blk", "cls", "copies", "unit")
    rows = rows.repartition(partitions(spark), "bucket", "t", "bi", "bj").sortWithinPartitions("bucket", "t", "bi", "bj", "cls")
    found = stash.put(rows.mapInArrow(_compare(cosine), "cls long, links long, to long"), "found")
    joined = components(stash, found.select(F.col("cls").alias("a"), F.col("to").alias("b")))
    named = classes.join(joined, classes.cls == joined.node, "left").select("cls", "rep", "copies", F.coalesce("component", "cls").alias("component"))
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    links = found.groupBy("cls").agg(F.sum("links").alias("links"))
    label = named.join(smallest, "component").join(links, "cls", "left")
    label = stash.put(label.select("cls", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "labels")
    stash.keep(feats, label)
    out = feats.select("vec_id", "cls").join(label, "cls", "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with a cosine of 0.95 or more."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
