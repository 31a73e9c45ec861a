"""Operator 1: packing documents into windows of equal capacity.

Method: Karmarkar-Karp multiway differencing. Each group of pieces starts as
partial partitions of one piece; the two with the largest differences are
merged so that the largest window of one meets the smallest of the other, until
one partition into ``k`` near-equal windows is left. ``k`` starts at the least
count that could hold the tokens and rises whenever a window exceeds capacity.

Pieces, not documents, are dealt into groups by a hash, whatever their source, so
a hot source spreads over all groups and the pieces of a very long document do
too; the number of groups follows the bytes of text, so a group's tokens are
bounded. Only piece lengths (and, on request, token ids) are shuffled.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import documents

CAPACITY = 2048
END_ID = 1
#: Pieces of a document's rest are at most this long, so that windows hold enough pieces to balance.
PIECE = 512
#: One document in ``FINE_EVERY`` is cut to pieces of at most this length; they level the windows at the end.
FINE, FINE_EVERY = 64, 8
#: Bytes of text whose pieces make a group.
GROUP_BYTES = 2_000_000


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


# --------------------------------------------------------------------------
# token ids


class _Cache(dict):
    """word -> its ids as bytes; emptied when full."""

    LIMIT = 700_000

    def __init__(self, ask: Callable[[str], bytes]):
        self.ask = ask

    def __missing__(self, word: str) -> bytes:
        out = self.ask(word)
        if len(word) <= 48:
            if len(self) >= self.LIMIT:
                self.clear()
            self[word] = out
        return out


class Ids:
    """Token ids of whole texts, by a ``tokenizers`` file, with a bounded cache.

    The tokenizer drops white space and never merges across it or across its
    own pre-tokens, so a text's ids are those of its pre-tokens in order. The
    model is asked once for each pre-token; normaliser and pre-tokeniser of the
    file are applied as they stand to all that is not plain letters.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.wide = self.whole.get_vocab_size() > 65536
        self.kind = np.uint32 if self.wide else np.uint16
        self.cache = _Cache(self._ask)
        self.simple = self._simple()

    def _simple(self) -> bool:
        """Whether words may be cut at spaces: checked on the file's own behaviour."""
        probe = "Don't stop, Ärger's 42nd  ñandú.\nEnd."
        return self.whole.encode(probe, add_special_tokens=False).ids == [i for w in probe.split() for i in self.whole.encode(w, add_special_tokens=False).ids]

    def _ask(self, word: str) -> bytes:
        if self.simple and _LATIN.fullmatch(word):
            ids = [t.id for t in self.model.tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(_BYTES))]
        else:
            ids = self.whole.encode(word, add_special_tokens=False).ids
        out = np.array(ids, dtype=self.kind).tobytes()
        return out

    def __call__(self, text: str | None) -> np.ndarray:
        """Unsigned ids of the text, without the end id."""
        if not text:
            return np.zeros(0, dtype=np.uint32)
        if not self.simple:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        # below U+0300 nothing composes, so lower case may come before the tokenizer's own normaliser
        if text.isascii() or _HIGH.search(text) is None:
            text = text.lower()
        parts = map(self.cache.__getitem__, _split_marks(text))
        return np.frombuffer(b"".join(parts), dtype=self.kind).astype(np.uint32)


def _split_marks(text: str) -> list[str]:
    """Words at blanks; a lone full stop or comma after a letter becomes a word of its own."""
    if _RUN.search(text) is None:
        text = text.replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ")
    else:
        text = _MARK.sub(r" \1", text)
    for blank in "\n\t\r":
        if blank in text:
            text = text.replace(blank, " ")
    return [w for w in text.split(" ") if w]


_HIGH = re.compile("[\u0300-\U0010ffff]")
#: Lower-case Latin letters, which are letters by any version of Unicode.
_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: A mark that may belong to the same pre-token as what is before it: words are cut before a mark
#: only after a digit or a Latin letter, which no pre-token unites with a mark.
_RUN = re.compile("[^0-9a-z\u00df-\u00f6\u00f8-\u00ff ][.,][ \n]")
_MARK = re.compile(r"(?<=[0-9a-z\u00df-\u00f6\u00f8-\u00ff])([.,])(?=[ \n])")
#: The byte-level alphabet: printable Latin-1 stands for itself, the other bytes for code points from 256 on.
_PLAIN = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = {b: b for b in _PLAIN} | {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PLAIN)}
_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    if path not in _IDS:
        _IDS[path] = Ids(path)
    return _IDS[path]


# --------------------------------------------------------------------------
# multiway differencing


def difference(sizes: np.ndarray, k: int) -> tuple[np.ndarray, list[list[int]]]:
    """Karmarkar-Karp partition of ``sizes`` into ``k`` windows: sums and members.

    A partial partition keeps the sums of its non-empty windows in descending
    order and, for each, a node of a merge forest; empty windows are implied.
    """
    n = len(sizes)
    left: list[int] = []
    right: list[int] = []
    heap: list[tuple[int, int]] = []
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for i, s in enumerate(sizes.tolist()):
        parts[i] = (np.array([s]), np.array([i]))
        heap.append((-s if k > 1 else 0, i))
    heapq.heapify(heap)
    fresh = n
    while len(heap) > 1:
        _, x = heapq.heappop(heap)
        _, y = heapq.heappop(heap)
        (sa, na), (sb, nb) = parts.pop(x), parts.pop(y)
        a, b = len(sa), len(sb)
        over = a + b - k
        if over > 0:
            # the smallest `over` windows of one meet the smallest of the other, crosswise
            lo_a, lo_b = a - over, b - over
            met = sa[lo_a:] + sb[lo_b:][::-1]
            ids = np.arange(n + len(left), n + len(left) + over)
            left.extend(na[lo_a:].tolist())
            right.extend(nb[lo_b:][::-1].tolist())
            sums = np.concatenate((sa[:lo_a], sb[:lo_b], met))
            nodes = np.concatenate((na[:lo_a], nb[:lo_b], ids))
        else:
            sums, nodes = np.concatenate((sa, sb)), np.concatenate((na, nb))
        order = np.argsort(-sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        least = int(sums[-1]) if len(sums) == k else 0
        parts[fresh] = (sums, nodes)
        heapq.heappush(heap, (least - int(sums[0]), fresh))
        fresh += 1
    sums, nodes = next(iter(parts.values())) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    members = []
    for node in nodes.tolist():
        stack, own = [node], []
        while stack:
            x = stack.pop()
            if x < n:
                own.append(x)
            else:
                stack += [right[x - n], left[x - n]]
        members.append(own)
    return sums, members


def windows(sizes: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Members of each window; the count rises until no window exceeds ``capacity``."""
    if not len(sizes):
        return []
    total = int(sizes.sum())
    k = max(1, -(-total // capacity))
    while True:
        sums, members = difference(sizes, k)
        if not len(sums) or int(sums[0]) <= capacity:
            return members
        # to where a spread like this one would fit, one more at least
        spread = float(sums[0]) - total / k
        k = max(k + 1, int(total / max(1.0, capacity - 0.7 * spread)))


def cuts(n: int, capacity: int = CAPACITY, piece: int = PIECE) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full windows, then near-equal pieces of the rest."""
    full = n // capacity
    out = [(i * capacity, capacity) for i in range(full)]
    rest, at = n - full * capacity, full * capacity
    if rest:
        m = -(-rest // piece)
        for i in range(m):
            size = rest // m + (i < rest % m)
            out.append((at, size))
            at += size
    return out


# --------------------------------------------------------------------------
# the operator


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, piece: int = PIECE, payload: tuple[str, Callable, pa.DataType] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each piece: ``doc_id, start, length, doc_tokens, tie`` and the payload.

    ``payload`` is (column, function of a piece's unsigned ids, Arrow type); by
    default the ids themselves (``ids array<int>``). ``tie`` is a checksum that
    spreads rows whose doc_id is null or repeated.
    """
    name, make, kind = payload or ("ids", lambda x: x.astype(np.int32), pa.list_(pa.int32()))
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("tie", pa.int64()), (name, kind)])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ids_of(vocabulary)
        for big in it:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                rows: list[list] = [[] for _ in schema]
                for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    ids = np.append(encode(t), np.uint32(END_ID)).astype("<u4")
                    tie = zlib.crc32(ids.tobytes())
                    for start, size in cuts(len(ids), capacity, piece if tie % FINE_EVERY else min(piece, FINE)):
                        for col, v in zip(rows, (d, start, size, len(ids), tie, make(ids[start : start + size]))):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(rows, schema)], schema=schema)

    ddl = f"doc_id long, start long, length long, doc_tokens long, tie long, {name} " + ("array<int>" if payload is None else "long")
    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("string")).mapInArrow(run, ddl)


def pack(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, piece: int = PIECE, group_bytes: int = GROUP_BYTES, payload=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Pieces with the window that holds them: ``sequence_id`` and ``offset``.

    Null text counts as empty; every document ends with ``END_ID``, so an empty
    one is a piece of one token. Rows with a null or repeated doc_id are packed
    like others. Other columns of ``docs`` are ignored. An empty table gives no
    rows. The result is the same at every run: groups and order within them
    depend on ids and contents alone.
    """
    vocabulary = vocabulary or default_vocabulary()
    size = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 1)).first()[0] or 0
    n_groups = max(1, -(-size // group_bytes))
    cut = pieces(docs, vocabulary, capacity, piece, payload, doc_id, text)
    extra = cut.schema[-1]

    def assign(key, pdf):
        pdf = pdf.sort_values(["doc_id", "tie", "start"], kind="stable", na_position="first").reset_index(drop=True)
        length = pdf["length"].to_numpy()
        seq, off = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
        base = int(key[0]) << 32
        rest = np.flatnonzero(length < capacity)
        n = 0
        for own in windows(length[rest], capacity):
            at = 0
            for i in own:
                j = rest[i]
                seq[j], off[j] = base + n, at
                at += int(length[j])
            n += 1
        full = np.flatnonzero(length == capacity)
        seq[full] = base + n + np.arange(len(full))
        pdf["sequence_id"], pdf["offset"] = seq, off
        return pdf[["doc_id", "start", "length", extra.name, "doc_tokens", "sequence_id", "offset"]]

    grouped = cut.withColumn("grp", F.pmod(F.xxhash64("doc_id", "tie", "start"), F.lit(n_groups)))
    ddl = f"doc_id long, start long, length long, {extra.name} {extra.dataType.simpleString()}, doc_tokens long, sequence_id long, offset long"
    return grouped.groupBy("grp").applyInPandas(assign, ddl)


CRC = ("ids_crc32", lambda ids: zlib.crc32(ids.tobytes()), pa.int64())


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens; a digest of ids for each piece."""
    return pack(documents(spark, sf_dir), payload=CRC)
