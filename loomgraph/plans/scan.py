"""The two steps of ranked retrieval that run in Python: inverting a document, and scoring documents for a batch of queries.

Both go over documents in Arrow batches and look at one document by itself, so
nothing is shuffled but the best documents of each query.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import terms

#: Documents inverted at once, and cells of documents by queries that are scored at once.
TOGETHER, CELLS = 256, 1 << 19
#: Scores are rounded later; what lies this near below a bound may still reach it.
SLACK = 1e-8

_TOKENS = re.compile(rb"[a-z0-9]{2,}").findall
_TERMS = pa.list_(pa.struct([("stem", pa.string()), ("positions", pa.list_(pa.int32()))]))


def _inverted(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    stems = terms.Stems()
    for big in it:
        for at in range(0, big.num_rows, TOGETHER):
            b = big.slice(at, TOGETHER)
            lengths, sizes, names, counts, places, fresh, n_fresh = [], [], [], [], [], [], []
            for text in b.column("text").to_pylist():
                found: dict[bytes, list[int]] = {}
                pos = 0
                for word in _TOKENS(text):
                    stem = stems[word]
                    if stem is None:
                        continue
                    if stem in found:
                        found[stem].append(pos)
                    else:
                        found[stem] = [pos]
                    pos += 1
                lengths.append(pos)
                fresh += stems.fresh
                n_fresh.append(len(stems.fresh))
                stems.fresh = []
                sizes.append(len(found))
                names.extend(found)
                for x in found.values():
                    counts.append(len(x))
                    places.extend(x)
            offsets = lambda n: pa.array(np.concatenate(([0], np.cumsum(n, dtype=np.int64))).astype(np.int32))
            positions = pa.ListArray.from_arrays(offsets(counts), pa.array(np.array(places, np.int32)))
            each = pa.StructArray.from_arrays([pa.array(names, pa.binary()).cast(pa.string()), positions], fields=list(_TERMS.value_type))
            words = pa.ListArray.from_arrays(offsets(n_fresh), pa.array(fresh, pa.binary()).cast(pa.string()))
            cols = [b.column(c) for c in ("id", "ord", "title", "subtype")] + [pa.array(lengths, pa.int32()), words, pa.ListArray.from_arrays(offsets(sizes), each, type=_TERMS)]
            yield pa.RecordBatch.from_arrays(cols, names=["id", "ord", "title", "subtype", "length", "words", "terms"])


def inverted(nodes: DataFrame) -> DataFrame:
    """``id, ord, title, subtype, length, words, terms`` of nodes(id, ord, title, subtype, content), where ``terms`` has
    each stem of the document with its positions; these count after stop words are dropped. ``words`` are those for the
    spelling vocabulary that the task had not met before; only those of all rows together mean something."""
    n = nodes.select("id", "ord", "title", "subtype", terms.index_text(F.col("title"), F.col("content")).cast("binary").alias("text"))
    kinds = {f.name: f.dataType.simpleString() for f in n.schema}
    ddl = ", ".join(f"{c} {kinds[c]}" for c in ("id", "ord", "title", "subtype"))
    return n.mapInArrow(_inverted, f"{ddl}, length int, words array<string>, terms array<struct<stem: string, positions: array<int>>>")


def spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each span, one after the other."""
    return np.arange(size.sum()) + np.repeat(start - np.cumsum(size) + size, size)


@dataclass(frozen=True)
class Run:
    """Constants of one scoring of a batch."""

    k1: float = 1.5
    b: float = 0.75
    window: int = 30
    proximity: float = 0.3


@dataclass
class Batch:
    """The stems of a batch of queries, as tasks get them: numbered in order, with the queries that have each."""

    rows: list  # (qid, stem, idf), distinct
    avgdl: float
    runs: tuple[Run, ...]
    limit: int | None = None
    qids: list = field(init=False)
    names: list[str] = field(init=False)

    def __post_init__(self) -> None:
        self.qids = list(dict.fromkeys(r[0] for r in self.rows))
        self.names = sorted({r[1] for r in self.rows})
        number, stem = {q: i for i, q in enumerate(self.qids)}, {s: i for i, s in enumerate(self.names)}
        self.idf = np.zeros(len(self.names))
        pairs = np.array(sorted((stem[s], number[q]) for q, s, _ in self.rows), np.int64).reshape(-1, 2)
        for _, s, idf in self.rows:
            self.idf[stem[s]] = idf
        self.query = pairs[:, 1]
        self.edge = np.searchsorted(pairs[:, 0], np.arange(len(self.names) + 1))
        del self.rows


def near(cell: np.ndarray, row: np.ndarray, pos: np.ndarray, n_rows: int, windows: set[int]) -> dict[int, np.ndarray]:
    """Which rows, each a stem of a cell, have another one of their cell within a window, by window.

    Of all positions of a cell in order, a stem is near another one just if it is so at two that follow each other.
    """
    by = np.argsort((cell << np.int64(32)) | pos, kind="stable")
    cell, row, pos = cell[by], row[by], pos[by]
    other = (cell[1:] == cell[:-1]) & (row[1:] != row[:-1])
    gap = pos[1:] - pos[:-1]
    out = {}
    for w in windows:
        at = np.flatnonzero(other & (gap <= w))
        out[w] = np.zeros(n_rows, bool)
        out[w][row[at]] = out[w][row[at + 1]] = True
    return out


class Scorer:
    """Scores of documents for a batch of queries. Of each run and query it remembers the ``limit`` best scores so far,
    as a document whose score cannot reach the least of these is none of the best."""

    def __init__(self, batch: Batch):
        self.of = batch
        self.value_set = pa.array(batch.names, pa.string())
        most = 0 if batch.limit is None else batch.limit
        self.best = [np.full((len(batch.qids), most), -np.inf) for _ in batch.runs]
        self.step = max(1, CELLS // max(1, len(batch.qids)))

    def least(self, run: int) -> np.ndarray:
        best = self.best[run]
        return best.min(axis=1) if best.shape[1] else np.full(len(best), -np.inf)

    def scored(self, length: np.ndarray, t: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Run, document, query, plain score and number of near stems of those that may be among the best."""
        of, n_q, n_d = self.of, len(self.of.qids), len(length)
        outer, struct = t.offsets.to_numpy().astype(np.int64), t.values
        stem, places = struct.field("stem"), struct.field("positions")
        lo, hi = outer[0], outer[-1]
        at = pc.index_in(stem.slice(lo, hi - lo), value_set=self.value_set).fill_null(-1).to_numpy().astype(np.int64)
        has = np.flatnonzero(at >= 0)
        if not len(has):
            return
        doc = np.repeat(np.arange(n_d), np.diff(outer))[has]
        stem_of = at[has]
        inner, values = places.offsets.to_numpy().astype(np.int64), places.values.to_numpy()
        start = inner[has + lo]
        tf = inner[has + lo + 1] - start
        # a row for each query that has the stem
        size = of.edge[stem_of + 1] - of.edge[stem_of]
        entry = np.repeat(np.arange(len(has)), size)
        query = of.query[spans(of.edge[stem_of], size)]
        cell = doc[entry] * n_q + query
        n_stems = np.bincount(cell, minlength=n_d * n_q)
        cells = np.flatnonzero(n_stems)
        m, q = n_stems[cells], cells % n_q
        raws, may = [], []
        for k, run in enumerate(of.runs):
            count = tf.astype(np.float64)
            part = of.idf[stem_of] * count * (run.k1 + 1) / (count + run.k1 * (1 - run.b + run.b * length[doc] / of.avgdl))
            raw = np.bincount(cell, part[entry], n_d * n_q)[cells]
            top = np.where(m > 1, raw * (1 + max(run.proximity, 0) * (m - 1)), raw)
            raws.append(raw)
            may.append(top >= self.least(k)[q] - SLACK)
        wanted = np.zeros(n_d * n_q, bool)
        wanted[cells[np.logical_or.reduce(may) & (m > 1)]] = True
        rows = np.flatnonzero(wanted[cell])
        spot_row = np.repeat(np.arange(len(rows)), tf[entry[rows]])
        spot = values[spans(start[entry[rows]], tf[entry[rows]])].astype(np.int64)
        flags = near(cell[rows][spot_row], spot_row, spot, len(rows), {r.window for r in of.runs})
        n_near = {w: np.bincount(cell[rows][f], minlength=n_d * n_q)[cells] for w, f in flags.items()}
        for k, run in enumerate(of.runs):
            n = n_near[run.window]
            score = np.where(n > 1, raws[k] * (1 + run.proximity * (n - 1)), raws[k])
            if of.limit is not None:
                self.add(k, q[may[k]], cells[may[k]] // n_q, score[may[k]], n_d)
            keep = np.flatnonzero(may[k] & (score >= self.least(k)[q] - SLACK))
            yield k, cells[keep] // n_q, q[keep], raws[k][keep], n[keep]

    def add(self, run: int, query: np.ndarray, doc: np.ndarray, score: np.ndarray, n_d: int) -> None:
        touched, line = np.unique(query, return_inverse=True)
        fresh = np.full((len(touched), n_d), -np.inf)
        fresh[line, doc] = score
        every = np.concatenate((self.best[run][touched], fresh), axis=1)
        limit = self.of.limit
        if limit:
            self.best[run][touched] = np.partition(every, every.shape[1] - limit, axis=1)[:, -limit:]


def scored(entries: DataFrame, batch: Batch) -> DataFrame:
    """``run, qid, id, ord, raw, n_near`` of all documents that may be among the best ``limit`` of a query, of each partition."""
    kinds = {f.name: f.dataType.simpleString() for f in entries.schema}

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Scorer(batch)
        qids = pa.array(batch.qids, pa.string())
        for big in it:
            for at in range(0, big.num_rows, s.step):
                b = big.slice(at, s.step)
                length = b.column("length").to_numpy().astype(np.float64)
                for k, doc, query, raw, n in s.scored(length, b.column("terms")):
                    cols = [pa.array(np.full(len(doc), k, np.int32)), qids.take(pa.array(query)), b.column("id").take(pa.array(doc)), b.column("ord").take(pa.array(doc)), pa.array(raw), pa.array(n.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays(cols, names=["run", "qid", "id", "ord", "raw", "n_near"])

    return entries.select("id", "ord", "length", "terms").mapInArrow(run, f"run int, qid string, id {kinds['id']}, ord {kinds['ord']}, raw double, n_near int")
