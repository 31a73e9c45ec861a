"""What the two operators on repeated passages share.

Both select anchors in each text by its content, keep those whose key occurs in
more than one document, sort them, pair each with its neighbours of other
documents under the same key, fetch the two texts of a pair and report the
passages that are confirmed on them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._shared import ASCII_SPACE, U64, Stash, partitions, with_texts

PLACE_BITS = 20
#: The rows of a key with more of them may be dealt to several tasks.
WHOLE = 4096


def sliding_minimum(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    m, have = v, 1
    while have * 2 <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[: len(m) - rest], m[rest:]) if rest else m


def minima(h: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows of ``width`` items with the same least item.

    Returns place of the item, first window and last window of each run; texts
    with fewer items have one window of all. Values keep their upper 44 bits,
    the others tell places apart; ties go to the first place.
    """
    n = len(h)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    width = min(width, n)
    places, first, last = [], [], []
    step = (1 << PLACE_BITS) - width
    for at in range(0, n - width + 1, step):
        part = h[at : at + (1 << PLACE_BITS) - 1]
        packed = (part & ~U64((1 << PLACE_BITS) - 1)) | np.arange(len(part), dtype=U64)
        m = (sliding_minimum(packed, width) & U64((1 << PLACE_BITS) - 1)).astype(np.int64)[:step]
        head = np.flatnonzero(np.concatenate(([True], m[1:] != m[:-1])))
        places.append(m[head] + at)
        first.append(head + at)
        last.append(np.append(head[1:] - 1, len(m) - 1) + at)
    return np.concatenate(places), np.concatenate(first), np.concatenate(last)


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``uid, doc_id, text``; rows with the same doc_id and text share a uid."""
    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return d.select(F.xxhash64("doc_id", "text").alias("uid"), "doc_id", "text")


def repeated(stash: Stash, rows: DataFrame, columns: list[str], ends: bool = False) -> DataFrame:
    """Rows ``key, uid, ...`` whose key more than one document has, with the key's number of rows ``n``.

    ``lo`` and ``hi`` are the key's least and greatest row, null where it has at
    most ``WHOLE`` rows, unless ``ends`` asks for them.
    """
    rows = stash.put(rows, "anchors")
    row = F.struct("uid", *columns)
    many = rows.groupBy("key").agg(F.count("*").alias("n"), F.min(row).alias("lo"), F.max(row).alias("hi")).where("lo.uid < hi.uid")
    if not ends:
        many = many.select("key", "n", *(F.when(F.col("n") > WHOLE, F.col(c)).alias(c) for c in ("lo", "hi")))
    many = stash.put(many, "keys")
    both = stash.put(rows.join(many, "key"), "repeated")
    stash.drop(rows, many)
    return both


def neighbours(rows: DataFrame, order: list[str], columns: list[str], back: int = 1, every: int = 0) -> DataFrame:
    """Pairs ``a, b`` of documents next to each other under a key, with both rows' ``columns``.

    Rows ``key, uid, *columns, n, lo, hi`` are sorted by key, ``order`` and uid, and
    dealt by ranges: of keys, and for frequent ones of all of these, so that their
    rows go to as many tasks as they need. Each row meets the nearest row before it of the
    ``back`` documents before it; those of a key's first document in a task meet
    the next one's. A document that is alone with a key in its task meets the
    key's least or greatest row, so none is left without a partner. Where a key has
    at most ``every`` rows, all its documents meet.
    """
    spark = rows.sparkSession
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    names = ["a", "b", *columns, *(f"{c}_b" for c in columns)]
    ddl = "a long, b long, " + ", ".join([f"{c} {kinds[c]}" for c in columns] + [f"{c}_b {kinds[c]}" for c in columns])
    n_order, n_cols = len(order), len(columns)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cols in whole_groups(it, 1):
            key, near, uid = cols[0], cols[1 : 1 + n_order], cols[1 + n_order]
            at = 2 + n_order + n_cols
            vals, n, lo, hi = cols[2 + n_order : at], cols[at], cols[at + 1 : at + n_cols + 2], cols[at + n_cols + 2 :]
            fresh_key = np.concatenate(([True], key[1:] != key[:-1]))
            fresh = fresh_key | np.concatenate(([True], uid[1:] != uid[:-1]))
            for c in near:
                fresh[1:] |= c[1:] != c[:-1]
            run_of = np.cumsum(fresh) - 1  # runs of rows of one document, numbered through the chunk
            head = np.flatnonzero(fresh)
            key_of = np.cumsum(fresh_key)[head] - 1
            first = np.flatnonzero(fresh_key[head])[key_of]  # first run of each run's key
            size = np.bincount(key_of)[key_of]
            lead = first == np.arange(len(head))
            left = [np.flatnonzero((lead & (size > 1))[run_of])]
            right = [head[run_of[left[0]] + 1]]
            for k in range(1, max(back + 1, every)):
                own = np.flatnonzero((run_of - k >= first[run_of]) & ((k <= back) | (n <= every)))
                if not len(own):
                    break
                left.append(own)
                right.append(head[run_of[own] - k])
            i, j = np.concatenate(left), np.concatenate(right)
            # the next run may be the same document's in another place of the order
            other = uid[i] != uid[j]
            i, j = i[other], j[other]
            met = np.zeros(len(key), bool)
            met[i] = True
            alone = np.flatnonzero(~met & (n > WHOLE))
            low = lo[0][alone] != uid[alone]
            one = [np.where(low, x[alone], y[alone]) for x, y in zip(lo, hi)]
            a, b = np.concatenate((uid[i], uid[alone])), np.concatenate((uid[j], one[0]))
            own = [np.concatenate((v[i], v[alone])) for v in vals]
            its = [np.concatenate((v[j], o.astype(v.dtype))) for v, o in zip(vals, one[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (a, b, *own, *its)], names=names)

    frequent = F.col("n") > WHOLE
    ends = [F.when(frequent, F.col(f"{e}.{c}")).otherwise(0).alias(f"{e}_{c}") for e in ("lo", "hi") for c in ("uid", *columns)]
    by = ["key", *order, "uid", *columns]
    ranges = [F.when(frequent, F.col(c)).otherwise(0) for c in (*order, "uid")]
    dealt = rows.select(*by, "n", *ends).repartitionByRange(partitions(spark), "key", *ranges).sortWithinPartitions(*by)
    return dealt.mapInArrow(run, ddl)


def whole_groups(it: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Columns of chunks of sorted rows that end where a group of the first ``n_keys`` columns ends."""
    held: list[np.ndarray] | None = None
    for b in it:
        cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
        if held is not None:
            cols = [np.concatenate(x) for x in zip(held, cols)]
        change = np.zeros(max(0, len(cols[0]) - 1), bool)
        for c in cols[:n_keys]:
            change |= c[1:] != c[:-1]
        at = np.flatnonzero(change)
        cut = int(at[-1]) + 1 if len(at) else 0
        if cut:
            yield [c[:cut] for c in cols]
        held = [c[cut:] for c in cols]
    if held is not None and len(held[0]):
        yield held


Found = tuple[int, int, int, int]  # words of a from, to; of b from, to


def confirm(stash: Stash, pairs: DataFrame, texts: DataFrame, check: Callable[[str, str, list], list[Found]]) -> DataFrame:
    """``doc_id, start, end, n_words, other_doc_id``, from pairs ``a, b, seeds``."""
    needed = pairs.select(F.col("a").alias("uid")).unionAll(pairs.select("b")).distinct()
    own = stash.put(texts.join(needed, "uid").select("uid", "doc_id", "text"), "texts")
    found = confirmed(stash, pairs, own, lambda a, b, seeds: (check(a, b, seeds), []))
    stash.keep(found, own)
    return passages(found, own)


def confirmed(stash: Stash, pairs: DataFrame, texts: DataFrame, check: Callable[[str, str, list], tuple[list[Found], list[Found]]]) -> DataFrame:
    """``uid, start, end, other, o_start, o_end`` in words, from pairs ``a, b, seeds``; ``check`` gives finds of a and of b."""
    both = with_texts(pairs, texts, "uid").select("a", "b", "seeds", "text_a", "text_b")
    schema = pa.schema([(c, pa.int64()) for c in ("uid", "start", "end", "other", "o_start", "o_end")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in it:
            for at in range(0, big.num_rows, 200):
                out = []
                for a, b, seeds, ta, tb in zip(*(big.slice(at, 200).column(i).to_pylist() for i in range(5))):
                    of_a, of_b = check(ta, tb, seeds)
                    out += [(a, s, e, b, os, oe) for s, e, os, oe in of_a]
                    out += [(b, s, e, a, os, oe) for s, e, os, oe in of_b]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

    return stash.put(both.mapInArrow(run, "uid long, start long, end long, other long, o_start long, o_end long"), "found")


def passages(found: DataFrame, texts: DataFrame) -> DataFrame:
    """Overlapping finds of a document as one passage, with code point offsets.

    ``doc_id, start, end, n_words, other_doc_id``: the other document is the one
    of the passage's longest find.
    """
    ids = texts.select(F.col("uid").alias("other"), F.col("doc_id").alias("other_doc_id")).distinct()
    finds = found.join(ids, "other").groupBy("uid").agg(F.collect_set(F.struct("start", "end", "other_doc_id")).alias("finds"))
    rows = finds.join(texts.dropDuplicates(["uid"]), "uid").select("doc_id", "text", "finds")
    schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "start", "end", "n_words", "other_doc_id")])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in it:
            for at in range(0, big.num_rows, 500):
                out = []
                for d, text, finds in zip(*(big.slice(at, 500).column(i).to_pylist() for i in range(3))):
                    spots = [m.span() for m in ASCII_SPACE.finditer(text)]
                    merged: list[list] = []
                    for f in sorted(finds, key=lambda f: (f["start"], -f["end"], f["other_doc_id"] is None, f["other_doc_id"] or 0)):
                        size = f["end"] - f["start"]
                        if merged and f["start"] < merged[-1][1]:
                            if size > merged[-1][2]:
                                merged[-1][2:] = [size, f["other_doc_id"]]
                            merged[-1][1] = max(merged[-1][1], f["end"])
                        else:
                            merged.append([f["start"], f["end"], size, f["other_doc_id"]])
                    out += [(d, spots[s][0], spots[e - 1][1], e - s, o) for s, e, _, o in merged]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 5, schema=schema)

    return rows.mapInArrow(run, "doc_id long, start long, end long, n_words long, other_doc_id long")
