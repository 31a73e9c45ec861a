"""Operator 4: document fingerprints by one-permutation MinHash.

The 5-word shingles of a text are hashed once; the upper bits choose one of
``BINS`` bins and each bin keeps its least remainder. Empty bins are filled by
optimal densification: every bin has its own random order of all bins and
borrows from the first non-empty one in it, so that a borrowed bin agrees
between two sets just as often as a filled one. Only the ``BITS`` low-order bits
of each bin are stored, packed, as Base64; as unequal minima agree in them with
probability ``2**-BITS``, likeness corrects for that.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import U64, documents, mix, partitions, shingle_set

BINS, BITS = 512, 4


def _orders() -> np.ndarray:
    """rank[j, i]: place of bin i in bin j's own order."""
    rng = np.random.default_rng(771)
    return np.stack([rng.permutation(BINS) for _ in range(BINS)]).astype(np.uint16)


_RANK = None


def bins(shingles: np.ndarray) -> np.ndarray | None:
    """Low-order bits of each bin after densification; None for an empty set."""
    global _RANK
    if not len(shingles):
        return None
    if _RANK is None:
        _RANK = _orders()
    h = mix(shingles)
    where = (h >> U64(64 - 9)).astype(np.int64)
    order = np.lexsort((h, where))
    where, h = where[order], h[order]
    head = np.flatnonzero(np.concatenate(([True], where[1:] != where[:-1])))
    full = where[head]
    out = np.zeros(BINS, np.uint64)
    out[full] = h[head]
    if len(full) < BINS:
        empty = np.ones(BINS, bool)
        empty[full] = False
        empty = np.flatnonzero(empty)
        donor = full[np.argmin(_RANK[empty][:, full], axis=1)]
        out[empty] = out[donor]
    # mixed again, as the low bits of a minimum are as random as the rest only by the hash
    return (mix(out) & U64(2**BITS - 1)).astype(np.uint8)


def pack(b: np.ndarray | None) -> str:
    """Two bins to a byte, in Base64; the empty string for an empty set."""
    if b is None:
        return ""
    return base64.b64encode((b[0::2] << 4 | b[1::2]).tobytes()).decode("ascii")


def unpack(fingerprint: str) -> np.ndarray | None:
    if not fingerprint:
        return None
    raw = np.frombuffer(base64.b64decode(fingerprint), np.uint8)
    return np.stack((raw >> 4, raw & 15), axis=1).reshape(-1)


def likeness(x: np.ndarray | None, y: np.ndarray | None) -> float:
    """Estimated Jaccard similarity from stored bits, corrected for chance agreement.

    Two empty sets are alike (1), an empty and another one are not (0).
    """
    if x is None or y is None:
        return 1.0 if x is y else 0.0
    chance = 2.0**-BITS
    return float(min(1.0, max(0.0, ((x == y).mean() - chance) / (1 - chance))))


SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])


def edited(text: str, following: str) -> str:
    """The last third (rounded down) gives way to as much of the start of the next text."""
    m = len(text) // 3
    return text[: len(text) - m] + following[:m]


def _walk(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by (bucket, place descending); in each bucket the last one is the halo."""
    before = None  # (bucket, doc_id, text, bins) still waiting for its next
    for big in it:
        for at in range(0, big.num_rows, 500):
            b = big.slice(at, 500)
            rows: list[list] = [[] for _ in SCHEMA]
            for bucket, halo, d, t in zip(*(b.column(i).to_pylist() for i in range(4))):
                t = t or ""
                if before is not None and before[0] == bucket and before[4]:
                    continue  # the halo of this bucket has been met
                own = bins(shingle_set(t))
                if before is not None and before[0] == bucket:
                    _, d0, t0, b0, _ = before
                    text = edited(t0, t)
                    e = bins(shingle_set(text)) if text != t0 else b0
                    for col, v in zip(rows, (d0, len(t0), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(), pack(b0), pack(e), likeness(b0, e), likeness(b0, own))):
                        col.append(v)
                before = (bucket, d, t, own, halo)
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, SCHEMA)], schema=SCHEMA)


def _least(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least key of a partition."""
    best = None
    for b in it:
        if b.num_rows:
            cols = [b.column(i).to_numpy() for i in range(3)]
            i = np.lexsort(cols[::-1])[0]
            key = tuple(int(c[i]) for c in cols)
            best = key if best is None else min(best, key)
    if best is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in best], names=list(KEY))


#: Columns of the order: null ids last, ids descending, ties by a hash of the text.
KEY = ("k0", "k1", "k2")


def _range_of(starts: list[tuple]) -> tuple:
    """Number of the range that a row's key is in, by bisection, and whether it is the range's first key."""
    # each column of the starts is one literal, whatever their number
    cols = [F.split(F.lit(",".join(str(s[i]) for s in starts)), ",").cast("array<bigint>") for i in range(3)]

    def first(at):
        return [F.get(c, at) for c in cols]

    def step(acc, _):
        mid = F.shiftright(acc["lo"] + acc["hi"] + 1, 1)
        a, b, c = first(mid)
        k0, k1, k2 = (F.col(k) for k in KEY)
        reached = (a < k0) | ((a == k0) & ((b < k1) | ((b == k1) & (c <= k2))))
        return F.struct(F.when(reached, mid).otherwise(acc["lo"]).alias("lo"), F.when(reached, acc["hi"]).otherwise(mid - 1).alias("hi"))

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(starts) - 1).alias("hi"))
    number = F.aggregate(F.sequence(F.lit(1), F.lit(len(starts).bit_length())), start, step)["lo"]
    is_first = [F.col(k) == x for k, x in zip(KEY, first(F.col("bucket")))]
    return number, is_first[0] & is_first[1] & is_first[2]


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_buckets: int | None = None) -> DataFrame:
    """A row for each row of ``docs`` with the columns of ``SCHEMA``.

    The next document is the one before in descending doc_id, ties by xxhash64
    of the text; a null doc_id comes after all others; after the last comes the
    first, so that a single document follows itself. Null text counts as empty.
    Rows that repeat one another follow each other. Other columns are ignored.
    An empty table gives no rows.

    Documents are dealt into even ranges of this order, one a task, whatever
    ids are null or repeated. The first row of each range is also sent to the
    range before it (its halo), so neighbours meet although no task sees more
    than one range. Only the first key of each range reaches the driver.
    """
    spark = docs.sparkSession
    n_buckets = n_buckets or partitions(spark)
    own, t = F.col(doc_id).cast("long"), F.coalesce(F.col(text).cast("string"), F.lit(""))
    key = [F.when(own.isNull(), 1).otherwise(0).cast("long").alias("k0"), F.coalesce(F.bitwise_not(own), F.lit(0)).alias("k1"), F.xxhash64(t).alias("k2")]
    d = docs.select(own.alias("doc_id"), t.alias("text"), *key)
    starts = sorted(tuple(r) for r in d.select(*KEY).repartitionByRange(n_buckets, *KEY).mapInArrow(_least, "k0 long, k1 long, k2 long").collect())
    if not starts:
        return spark.createDataFrame([], "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    number, is_first = _range_of(starts)
    d = d.withColumn("bucket", number)
    place = lambda at, halo: F.struct(at.cast("int").alias("bucket"), F.lit(halo).alias("halo"))
    here = place(F.col("bucket"), False)
    places = F.when(is_first, F.array(here, place(F.pmod(F.col("bucket") - 1, F.lit(len(starts))), True))).otherwise(F.array(here))
    rows = d.select("doc_id", "text", *KEY, F.explode(places).alias("p")).select("p.bucket", "p.halo", "doc_id", "text", *KEY)
    rows = rows.repartitionById(len(starts), "bucket").sortWithinPartitions("bucket", "halo", *KEY, "text").select("bucket", "halo", "doc_id", "text")
    return rows.mapInArrow(_walk, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all whole texts and of their edited texts."""
    return fingerprints(documents(spark, sf_dir))
