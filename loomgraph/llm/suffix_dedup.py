"""Operator 9: repeated passages by sparse suffix arrays.

Of all suffixes of a text only those are retained that start at a minimiser:
the word 8-gram with the least hash among 32 in a row. Of any ``LEAST`` words that
two documents have in common, one that has ``RIGHT`` of them to its right is
retained in both. Suffixes are brought into order by their first ``RIGHT`` words;
those that no other document has there are dropped. Where just two suffixes are
alike they are neighbours and are compared. Where there are more, the neighbour
with the longest match to the right need not have the longest one on both sides:
there the suffixes that start up to ``LEAST - RIGHT`` words before are retained as
well, all are sorted by their first ``LEAST`` words, and neighbours of different
documents that agree in all of these are compared. From the common start the match
is extended word by word to the left and to the right, and reported if it has
``LEAST`` words or more. The sorted order is dealt by ranges, so that the suffixes
of a passage that very many documents share are no hot group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._passages import Found, confirm, identified, minima, neighbours, repeated
from loomgraph.llm._shared import U64, Stash, documents, grams, mix, word_hashes

GRAM, WINDOW = 8, 32
RIGHT, LEAST = 19, 50


def anchors(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the retained suffixes and the word they start at."""
    h = word_hashes(text)
    n = len(h)
    if n < LEAST:
        z = np.zeros(0, np.int64)
        return z, z
    g = grams(h, GRAM)
    p, _, _ = minima(g, WINDOW)
    p = np.unique(p)
    if len(p) > 1 and (g[p[1:]] == g[p[:-1]]).any():
        kept, last = [], -WINDOW  # in a run of one 8-gram, one start for each window is enough
        for i, same in zip(p.tolist(), np.concatenate(([False], g[p[1:]] == g[p[:-1]])).tolist()):
            if not same or i - last >= WINDOW:
                kept.append(i)
                last = i
        p = np.array(kept)

    p = p[p + RIGHT <= n]
    key = np.zeros(len(p), U64)
    for i in range(RIGHT):
        key = key * U64(0x9E3779B97F4A7C15) + h[p + i]
    return mix(key).view(np.int64), p


def _anchor_rows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in it:
        for at in range(0, big.num_rows, 500):
            b = big.slice(at, 500)
            key, uid, pos = [], [], []
            for u, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                k, p = anchors(t)
                key.append(k)
                pos.append(p)
                uid.append(np.full(len(k), u))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(key)), pa.array(np.concatenate(uid).astype(np.int64)), pa.array(np.concatenate(pos).astype(np.int32))], names=["key", "uid", "pos"])


def _windows(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts and starts of suffixes -> first ``LEAST`` words of these suffixes and of those up to ``LEAST - RIGHT`` words before."""
    for big in it:
        for at in range(0, big.num_rows, 200):
            for u, t, starts in zip(*(big.slice(at, 200).column(i).to_pylist() for i in range(3))):
                g = grams(word_hashes(t), LEAST)
                edge = np.zeros(len(g) + 1, np.int64)
                for p in starts:
                    edge[min(max(0, p + RIGHT - LEAST), len(g))] += 1
                    edge[min(p + 1, len(g))] -= 1
                pos = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
                yield pa.RecordBatch.from_arrays([pa.array(g[pos].view(np.int64)), pa.array(np.full(len(pos), u, np.int64)), pa.array(pos.astype(np.int32))], names=["key", "uid", "pos"])


def _run(x: np.ndarray, y: np.ndarray) -> int:
    """How many items from the start on are equal."""
    n, at, step = min(len(x), len(y)), 0, 64
    while at < n:
        diff = x[at : min(n, at + step)] != y[at : min(n, at + step)]
        if diff.any():
            return at + int(diff.argmax())
        at, step = at + step, step * 4
    return n


def extend(text_a: str, text_b: str, seeds: list) -> list[Found]:
    """Maximal matches of ``LEAST`` words or more through the seeds (pos, pos_b)."""
    x, y = word_hashes(text_a), word_hashes(text_b)
    out: list[Found] = []
    covered = -1
    for p, q in sorted({(s["pos"], s["pos_b"]) for s in seeds}):
        if p < covered:
            continue
        left, right = _run(x[:p][::-1], y[:q][::-1]), _run(x[p:], y[q:])
        if left + right >= LEAST:
            out.append((p - left, p + right, q - left, q + right))
            covered = p + right
    return out


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, start, end, n_words, other_doc_id``: passages that another document has too.

    Offsets are code points, end exclusive; ``n_words`` counts words as runs
    free of U+0020 and U+0009..U+000D, compared with A-Z lower-cased. Finds that
    overlap are one passage. Null, empty and short texts have none. Rows with
    the same doc_id and text count as one document; a null doc_id is reported as
    null. Other columns are ignored. An empty table gives no rows.
    """
    stash = Stash(docs.sparkSession, "suffixes")
    d = identified(docs, doc_id, text)
    rows = repeated(stash, d.select("uid", "text").mapInArrow(_anchor_rows, "key long, uid long, pos int"), ["pos"], ends=True)
    side = lambda x, y: F.struct(F.col(f"{x}.uid").alias("a"), F.col(f"{y}.uid").alias("b"), F.col(f"{x}.pos").alias("pos"), F.col(f"{y}.pos").alias("pos_b"))
    two = rows.where("n = 2 and uid = lo.uid").select(F.explode(F.array(side("lo", "hi"), side("hi", "lo"))).alias("p")).select("p.*")
    starts = rows.where("n > 2").groupBy("uid").agg(F.collect_set("pos").alias("starts"))
    dense = d.select("uid", "text").join(starts, "uid").select("uid", "text", "starts").mapInArrow(_windows, "key long, uid long, pos int")
    # dense neighbours are sure to be a match, those of two suffixes are not and stay as they are
    met = two.withColumn("sure", F.lit(0)).unionAll(neighbours(repeated(stash, dense, ["pos"]), [], ["pos"]).withColumn("sure", F.lit(1)))
    # matches of LEAST words that begin less than that apart at one distance are one
    met = met.groupBy("a", "b", (F.col("pos") - F.col("pos_b")).alias("apart"), F.when(F.col("sure") == 1, F.floor(F.col("pos") / LEAST)).otherwise(-1 - F.col("pos")).alias("part")).agg(F.min("pos").alias("pos"))
    pairs = met.select("a", "b", F.struct("pos", (F.col("pos") - F.col("apart")).alias("pos_b")).alias("seed")).groupBy("a", "b").agg(F.collect_set("seed").alias("seeds"))
    return confirm(stash, stash.put(pairs, "pairs"), d, extend)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact passages of 50 words or more that documents share."""
    return repeated_passages(documents(spark, sf_dir))
