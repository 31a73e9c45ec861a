"""Plumbing that the operators of this subpackage have in common.

* a folder that driver and executors share, for tables that cut the lineage;
* word and shingle hashing in numpy;
* a distributed connected-components routine;
* fetching the two texts of a candidate pair for verification.

Nothing here collects rows of unbounded number to the driver.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
_STEP = U64(0x9E3779B97F4A7C15)
SHINGLE_WORDS = 5


# --------------------------------------------------------------------------
# tables in the shared folder


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, or the one the session checkpoints to.

    Where neither is set, a session in one local process gets a temporary one; on a
    cluster no folder of one machine would do, and an error says so.
    """
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    have = sc._jsc.sc().getCheckpointDir()
    if not folder and have.isDefined():
        folder = have.get()
    if not folder:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="loom-shared-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Stash:
    """Parquet tables of one operator run, written to the shared folder.

    ``put`` runs the plan once and returns a reader of what was written, so
    that later jobs neither repeat the work nor depend on one executor's disk.
    Shuffle files of the finished job are released at once.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.n = 0
        self.tables: list[DataFrame] = []

    def put(self, df: DataFrame, tag: str) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{tag}"
        before = self.spark.conf.get(CLEANUP, None)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(CLEANUP)
            else:
                self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._loom_path = path
        self.tables.append(out)
        return out

    def keep(self, *tables: DataFrame) -> None:
        """Remove all tables but these, which a result still reads."""
        paths = {t._loom_path for t in tables}
        self.drop(*[t for t in self.tables if t._loom_path not in paths])

    def drop(self, *tables: DataFrame) -> None:
        """Remove tables that nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._loom_path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        gone = {t._loom_path for t in tables}
        self.tables = [t for t in self.tables if t._loom_path not in gone]


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def crc_mod(col: Column, m: int) -> Column:
    """crc32 of the decimal text of ``col`` modulo ``m``; a null counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(m))


# --------------------------------------------------------------------------
# words and shingles


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased; words are runs free of U+0020 and U+0009..U+000D."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


_RANDOM = np.random.default_rng(65537)
#: A random number for each byte, one for both cases of A-Z.
_BYTE = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64)
_BYTE[65:91] = _BYTE[97:123]
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x2545F4914F6CDD1B
_POWERS = np.ones(1, np.uint64)
_INVERSE = np.ones(1, np.uint64)
BLOCK_BYTES = 1 << 18


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    out = np.ones(n, np.uint64)
    out[1:] = base % 2**64
    return np.cumprod(out, dtype=np.uint64)


def _block_hashes(raw: np.ndarray, blank: np.ndarray) -> np.ndarray:
    global _POWERS, _INVERSE
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank, [True])).view(np.int8)))
    start, end = edge[0::2], edge[1::2]
    n = len(raw)
    if n > len(_POWERS):
        size = max(n, 4096, min(2 * len(_POWERS), BLOCK_BYTES))
        _POWERS, _INVERSE = _powers(_BASE, size), _powers(pow(_BASE, -1, 2**64), size)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _POWERS[:n], out=sums[1:], dtype=np.uint64)
    # a word's polynomial hash, from prefix sums and moved to place 0
    h = (sums[end] - sums[start]) * _INVERSE[start]
    return mix(h + (end - start).astype(np.uint64) * _STEP)


def word_hashes(text: str | None) -> np.ndarray:
    """64-bit hash of each word of a text, in order, without a Python loop over words.

    Words and their case are those of ``words``. Long texts are taken in blocks
    that end at a blank.
    """
    if not text:
        return np.zeros(0, np.uint64)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    blank = _BLANK[raw]
    out, at = [], 0
    while at < len(raw):
        to = at + BLOCK_BYTES
        if to < len(raw):
            ahead = blank[to:]
            to = to + int(ahead.argmax()) if ahead.any() else len(raw)
        out.append(_block_hashes(raw[at:to], blank[at:to]))
        at = to
    return out[0] if len(out) == 1 else np.concatenate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    return x ^ (x >> U64(32))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive items; one over all items if there are fewer."""
    if not len(h):
        return h
    n_here = min(n, len(h))
    out = np.zeros(len(h) - n_here + 1, dtype=U64)
    for i in range(n_here):
        out = out * _STEP + h[i : len(h) - n_here + 1 + i]
    # a short sequence is another thing than the same words as part of a long one
    return mix(out + U64(n_here if n_here == n else n_here + 1000))


def shingle_set(text: str | None, n: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes of a whole text."""
    return np.unique(grams(word_hashes(text), n))


# --------------------------------------------------------------------------
# Arrow


def batches(fn: Callable[[dict[str, list]], dict[str, list] | None], schema: pa.Schema, rows: int = 2000):
    """mapInArrow function from a function on column lists; batches are cut to ``rows``."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in it:
            for at in range(0, big.num_rows, rows):
                out = fn(big.slice(at, rows).to_pydict())
                if out is not None and len(next(iter(out.values()))):
                    yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in schema], schema=schema)

    return run


# --------------------------------------------------------------------------
# graphs


def components(stash: Stash, edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (smallest reachable node) for every node of an edge.

    Alternating large-star and small-star steps: each links a node's neighbours
    to its smallest one, so that after about log(n) rounds every component is a
    star. Hub nodes only meet a minimum (combined map-side) and a join whose
    large side AQE may split, never a collected neighbour list.
    """
    e = edges.select(F.least(a, b).alias("v"), F.greatest(a, b).alias("u")).where("u > v").distinct()
    e = stash.put(e, "edges")
    seen = None
    while True:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u"), F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = large.unionAll(e.select("u", "v").join(low, "u").select("u", F.col("m").alias("v")).where("u > v")).distinct()
        t = stash.put(large, "large")
        low = t.groupBy("u").agg(F.min("v").alias("m"))
        small = t.join(low, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        s = stash.put(small, "small")
        stash.drop(e, t)
        e = s
        now = s.agg(F.count("*"), F.coalesce(F.sum(F.col("v").cast("decimal(38,0)")), F.lit(0)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(e.select("v", "v").distinct().toDF("node", "component"))


# --------------------------------------------------------------------------
# pairs


def with_texts(pairs: DataFrame, texts: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Adds ``text_a`` and ``text_b`` to ``pairs(a, b, ...)`` from ``texts(key, text)``.

    Two equi-joins. A side that many pairs share makes large partitions, which
    AQE may split as nothing above needs the rows of a key together.
    """
    ta = texts.select(F.col(key).alias("a"), F.col(text).alias("text_a"))
    tb = texts.select(F.col(key).alias("b"), F.col(text).alias("text_b"))
    return pairs.join(ta, "a").join(tb, "b")


ASCII_SPACE = re.compile(r"[^ \t-\r]+")


def groups(it: Iterator[pa.RecordBatch], keys: list[int]) -> Iterator[pa.Table]:
    """Complete groups of rows with equal key columns, from sorted batches.

    Only the group at hand is held; callers bound its size by salting.
    """
    held: list[pa.RecordBatch] = []
    held_key = None
    for b in it:
        if not b.num_rows:
            continue
        cols = [b.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), b.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            key = tuple(c[lo] for c in cols)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held_key = key
            held.append(b.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


class Merge(dict):
    """Union-find over arbitrary keys; the smallest key names a set."""

    def find(self, x):
        self.setdefault(x, x)
        root = x
        while self[root] != root:
            root = self[root]
        while self[x] != root:
            self[x], x = root, self[x]
        return root

    def union(self, x, y) -> None:
        x, y = self.find(x), self.find(y)
        if x != y:
            self[max(x, y)] = min(x, y)
