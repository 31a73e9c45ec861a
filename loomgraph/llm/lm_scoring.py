"""Operator 8: language-model scores from a weighted backoff automaton of order 3.

States of the automaton are the contexts seen in training: none, one word, or two
words (the start of text counts as a word). An arc for each n-gram seen carries
its smoothed probability and leads to the state of its last two words; a failure
arc leads from each context to the one without its first word. A text is scored
in one traversal from left to right that carries the state: follow the arc of
the next token, or else pay the failure arc's weight and try again from where it
leads; the state without context has an arc for every token. Smoothing is by
Dirichlet priors: p(x|h) = (c(hx) + mu p(x|h')) / (c(h) + mu), h' being h without
its first word, so the failure arc of h weighs mu / (c(h) + mu). The strength mu
of each order maximises the likelihood of the training tokens, each left out of
its own counts, where n-grams seen once fall to the prior and those seen more
often do not change with it; that takes only the number of n-grams seen once and
a histogram of the contexts' counts, over all training data.

The automaton grows with the corpus and is never gathered in one place. A group
of some megabytes of neighbouring rows asks for the counts of its distinct
n-grams: sorted keys are cut into ranges, one packed message for each shard of the
key space, along with the group's own training counts. A shard adds up the counts
of all messages and answers with the totals of those n-grams that other groups
have too, marked by a bit each, so nearly all that is shuffled are the keys, each
once for each group. Group and shard sizes rise with the square root of the
corpus, from 4 and 16 MB of text to 32 and 128 MB; at 100 TB a message still holds
some 10 n-grams, and the number of messages stays far below that of n-grams. The
part of the automaton that a group's texts can reach is built from the answers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import U64, Stash, crc_mod, documents, groups, mix, partitions, word_hashes

#: Least and most bytes of text in a group, and of text whose n-grams a shard holds.
GROUP_BYTES, GROUP_MOST = 4_000_000, 32_000_000
SHARD_BYTES, SHARD_MOST = 16_000_000, 128_000_000
#: Texts are walked in segments of as many tokens, side by side.
SEGMENT = 512
#: Bins of the histograms of counts: by the number of binary digits.
BINS = 64
END = np.uint64(0x5851F42D4C957F2D)
START = np.uint64(0x14057B7EF767814F)
ADD = 0.1
_MUL = U64(0x9E3779B97F4A7C15)


# --------------------------------------------------------------------------
# n-grams


def tokens(text: str) -> np.ndarray:
    """Hashes of the start of text, its words and the end."""
    return np.concatenate(([START], word_hashes(text), [END]))


def ngrams(seqs: list[np.ndarray]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Keys of all n-grams of orders 1 to 3 and the place of their last token; the order is in a key's last two bits."""
    s = np.concatenate(seqs)
    at = np.zeros(len(s), np.int64)  # place of a token in its text, 0 for the start
    ends = np.cumsum([len(x) for x in seqs])
    at[:] = np.arange(len(s)) - np.repeat(ends - [len(x) for x in seqs], [len(x) for x in seqs])
    out = []
    h = s
    for order in (1, 2, 3):
        if order > 1:
            h = h[:-1] * _MUL + s[order - 1 :]
        # a unigram is no start of text; an n-gram begins in its own text
        place = np.flatnonzero(at[order - 1 :] >= max(1, order - 1))
        out.append(((mix(h[place] + U64(order)) & ~U64(3)) | U64(order), place + order - 1))
    return out


def distinct(keys: list[np.ndarray], learnt: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Sorted distinct keys, how often each is learnt from, and for each order the number of every key."""
    every = np.concatenate(keys)
    found, where = np.unique(every, return_inverse=True)
    n = np.bincount(where, np.concatenate(learnt), len(found)).astype(np.int64)
    return found, n, np.split(where, np.cumsum([len(k) for k in keys])[:-1])


def encode(keys: np.ndarray) -> bytes:
    """Sorted keys as the byte planes of their differences; the high planes are mostly zeros."""
    d = np.diff(keys, prepend=U64(0))
    return np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T).tobytes()


def decode(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).reshape(-1), dtype=np.uint64)


def encode_counts(n: np.ndarray) -> bytes:
    """Counts under 255 in a byte each, the others in eight bytes at the end."""
    small = np.minimum(n, 255).astype(np.uint8)
    return small.tobytes() + n[n >= 255].astype(np.int64).tobytes()


def decode_counts(raw: bytes, length: int) -> np.ndarray:
    n = np.frombuffer(raw, np.uint8, length).astype(np.int64)
    big = np.flatnonzero(n == 255)
    n[big] = np.frombuffer(raw, np.int64, len(big), length)
    return n


def edges(keys: np.ndarray, shards: int) -> np.ndarray:
    """Where the shards' ranges of the key space begin and end among sorted keys."""
    first = (np.arange(1, shards).astype(object) * 2**64 // shards).astype(np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, first), [len(keys)]))


# --------------------------------------------------------------------------
# counts


def _requests(shards: int):
    """Rows ``grp, row, train, text`` -> a message for each shard from each run of a group's rows."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in groups(it, [0]):
            rows = g.column(1).to_numpy()
            seqs = [tokens(t) for t in g.column(3).to_pylist()]
            train = np.repeat(g.column(2).to_numpy().astype(bool), [len(x) for x in seqs])
            grams = ngrams(seqs)
            keys, n, _ = distinct([k for k, _ in grams], [train[p] for _, p in grams])
            cut = edges(keys, shards).tolist()
            out = [(i, g.column(0)[0].as_py(), int(rows[0]), int(rows[-1]), encode(keys[lo:hi]), encode_counts(n[lo:hi])) for i, (lo, hi) in enumerate(zip(cut, cut[1:])) if lo < hi]
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], names=["shard", "grp", "lo", "hi", "keys", "counts"])

    return run


def histogram(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many positive counts there are in each bin, and their sums."""
    n = n[n > 0]
    at = np.frexp(n.astype(float))[1]  # counts from 2**(i-1) up to 2**i - 1 are in bin i
    return np.bincount(at, minlength=BINS).astype(np.int64), np.bincount(at, n, BINS).astype(np.int64)


def _answers(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Messages of a shard -> which keys others have counts of, and those totals; a row with null lo carries histograms."""
    for g in groups(it, [0]):
        shard = g.column(0)[0].as_py()
        keys = [decode(k) for k in g.column(4).to_pylist()]
        own = [decode_counts(c, len(k)) for c, k in zip(g.column(5).to_pylist(), keys)]
        every = np.concatenate(keys)
        by = np.argsort(every, kind="stable")
        every = every[by]
        head = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        total = np.add.reduceat(np.concatenate(own)[by], head)
        every = every[head]
        del by, head
        stats = np.concatenate([x for o in (1, 2, 3) for x in histogram(total[(every & U64(3)) == U64(o)])])
        out = [(0, shard, None, None, b"", b"", stats)]
        for grp, lo, hi, k, n in zip(*(g.column(i).to_pylist() for i in (1, 2, 3)), keys, own):
            t = total[np.searchsorted(every, k)]
            out.append((grp, shard, lo, hi, np.packbits(t != n).tobytes(), encode_counts(t[t != n]), None))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.list_(pa.int64()))
        for at in range(0, len(out), 64):
            part = out[at : at + 64]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in part], t) for i, t in enumerate(kinds)], names=["grp", "shard", "lo", "hi", "other", "totals", "stats"])


def strength(once: int, number: np.ndarray, sums: np.ndarray) -> float:
    """The prior strength at which leaving tokens out is most likely, by bisection.

    ``once`` n-grams are seen once; ``number`` contexts of each bin have ``sums``
    tokens. The derivative of the likelihood is once / mu - sum(c(h) / (c(h) - 1 + mu)).
    """
    full = number > 0
    mean, tokens_ = sums[full] / number[full], sums[full]
    lo, hi = 1e-3, 1e9
    for _ in range(100):
        mu = (lo * hi) ** 0.5
        if once > (tokens_ * mu / (mean - 1 + mu)).sum():
            lo = mu
        else:
            hi = mu
    return float(lo)


# --------------------------------------------------------------------------
# the automaton


@dataclass(frozen=True)
class Model:
    """What all texts' automata have in common: training texts, tokens, words, and the prior strengths."""

    n_start: int
    total: int
    words: int
    mu2: float
    mu3: float


class Automaton:
    """The states and arcs that some texts can reach.

    State 0 has no context, state 1 is the start of text; then come one state
    for each word and one for each bigram of the texts. Contexts that training
    does not have are states that nothing leads to. Weights are log10.
    """

    def __init__(self, c1: np.ndarray, bigrams: tuple[np.ndarray, ...], trigrams: tuple[np.ndarray, ...], model: Model):
        """``bigrams``: counts, state of the first word, word; ``trigrams``: counts, number of its first bigram, of its last, word."""
        c2, before, w2 = bigrams
        c3, first, last, w3 = trigrams
        u = self.n_words = len(c1)
        p1 = (c1 + ADD) / (model.total + ADD * (model.words + 1))
        self.word = np.log10(p1)
        self.word_to = np.where(c1 > 0, 2 + np.arange(u), 0).astype(np.int32)
        context = np.concatenate(([0, model.n_start], c1))  # counts of the states of up to one word
        p2 = (c2 + model.mu2 * p1[w2]) / (context[before] + model.mu2)
        seen2, seen3 = np.flatnonzero(c2 > 0), np.flatnonzero(c3 > 0)
        first, last = first[seen3], last[seen3]
        p3 = (c3[seen3] + model.mu3 * p2[last]) / (c2[first] + model.mu3)
        code = np.concatenate((before[seen2] * u + w2[seen2], (2 + u + first) * u + w3[seen3]))
        by = np.argsort(code)
        self.arc = code[by]
        self.weight = np.log10(np.concatenate((p2[seen2], p3)))[by]
        self.to = np.concatenate((2 + u + seen2, 2 + u + last)).astype(np.int32)[by]
        self.failure = np.concatenate((np.zeros(2 + u, np.int64), 2 + w2)).astype(np.int32)
        self.failure_weight = np.log10(np.concatenate((model.mu2 / (context + model.mu2), model.mu3 / (c2 + model.mu3))))

    def walk(self, state: np.ndarray, words: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Weights of segments of ``words``, each walked from its first state; longest segments come first."""
        out = np.zeros(len(start))
        state = state.copy()
        for k in range(int(length[0]) if len(length) else 0):
            n = int(np.searchsorted(-length, -k))  # those that are longer than k
            s, x = state[:n], words[start[:n] + k]
            todo = np.arange(n)
            while len(todo):
                code = s[todo] * self.n_words + x[todo]
                at = np.minimum(np.searchsorted(self.arc, code), max(0, len(self.arc) - 1))
                hit = (self.arc[at] == code) if len(self.arc) else np.zeros(len(todo), bool)
                own = todo[hit]
                out[own] += self.weight[at[hit]]
                s[own] = self.to[at[hit]]
                todo = todo[~hit]
                root = s[todo] == 0
                own = todo[root]
                out[own] += self.word[x[own]]
                s[own] = self.word_to[x[own]]
                todo = todo[~root]
                out[todo] += self.failure_weight[s[todo]]
                s[todo] = self.failure[s[todo]]
        return out


def score_texts(texts: list[str], train: np.ndarray, totals, model: Model) -> tuple[np.ndarray, ...]:
    """Tokens, known ones, base score and score of each text.

    ``totals(keys, n)`` gives the training counts of sorted keys, ``n`` of which are these texts' own.
    """
    seqs = [tokens(t) for t in texts]
    lens = np.array([len(x) - 1 for x in seqs])
    learn = np.repeat(train, lens + 1)
    grams = ngrams(seqs)
    keys, own, (k1, k2, k3) = distinct([k for k, _ in grams], [learn[p] for _, p in grams])
    c = totals(keys, own)
    order = (keys & U64(3)).astype(np.int64)
    number = np.zeros(len(keys), np.int64)  # of a key among those of its order
    for i in (1, 2, 3):
        number[order == i] = np.arange((order == i).sum())
    of = [np.flatnonzero(order == i) for i in (1, 2, 3)]
    size = int((lens + 1).sum())
    word, bigram = np.zeros(size, np.int64), np.zeros(size, np.int64)
    word[grams[0][1]], bigram[grams[1][1]] = number[k1], number[k2]
    state = 2 + word  # of one word; the start of text has its own
    starts = np.cumsum(lens + 1) - lens - 1
    state[starts] = 1
    # what each distinct n-gram consists of, from any place it occurs
    before, w2 = np.zeros(len(of[1]), np.int64), np.zeros(len(of[1]), np.int64)
    first, last, w3 = (np.zeros(len(of[2]), np.int64) for _ in range(3))
    p = grams[1][1]
    before[number[k2]], w2[number[k2]] = state[p - 1], word[p]
    p = grams[2][1]
    first[number[k3]], last[number[k3]], w3[number[k3]] = bigram[p - 1], bigram[p], word[p]
    c1, c2, c3 = (c[x] for x in of)
    a = Automaton(c1, (c2, before, w2), (c3, first, last, w3), model)
    # segments: each begins in the state that the two tokens before it lead to
    n_seg = -(-lens // SEGMENT)
    doc = np.repeat(np.arange(len(lens)), n_seg)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n_seg) - n_seg, n_seg)
    begin = starts[doc] + 1 + nth * SEGMENT
    length = np.minimum(SEGMENT, lens[doc] - nth * SEGMENT)
    at = np.where(c2[bigram[begin - 1]] > 0, 2 + len(of[0]) + bigram[begin - 1], np.where(c1[word[begin - 1]] > 0, 2 + word[begin - 1], 0))
    at = np.where(nth == 0, 1, at)
    by = np.argsort(-length, kind="stable")
    score = np.bincount(doc[by], a.walk(at[by], word, begin[by], length[by]), len(lens))
    known = c[k1] > 0
    edge = np.cumsum(lens) - lens
    base = np.add.reduceat(np.log10(c[k1] + ADD), edge) - lens * np.log10(model.total + ADD * (model.words + 1))
    return lens, np.add.reduceat(known.astype(np.int64), edge), base, score


def _score(shards: int, model: Model):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (lo, hi), a in answers.groupby(["lo", "hi"]):
            own = docs[(docs["row"] >= lo) & (docs["row"] <= hi)]
            replies = {s: (o, t) for s, o, t in zip(a["shard"], a["other"], a["totals"])}

            def totals(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
                n, cut = n.copy(), edges(keys, shards).tolist()
                for s, (x, y) in enumerate(zip(cut, cut[1:])):
                    if x < y:
                        other, t = replies[s]  # noqa: B023
                        at = x + np.flatnonzero(np.unpackbits(np.frombuffer(other, np.uint8), count=y - x))
                        n[at] = decode_counts(t, len(at))
                return n

            lens, known, base, score = score_texts(own["text"].tolist(), ~own["held_out"].to_numpy(bool), totals, model)
            out.append(pd.DataFrame({"doc_id": own["doc_id"], "held_out": own["held_out"], "n_tokens": lens, "n_known": known, "train_tokens": model.total, "base_score": base, "score": score}))
        return pd.concat(out)

    return run


def _numbered(stash: Stash, docs: DataFrame, doc_id: str, text: str, held, plain: bool) -> DataFrame:
    """``doc_id, text, held_out, file, row``: rows by file and place; what is no plain reader of files is written first."""
    cols = [F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"), held.alias("held_out")]
    if not plain:
        docs, cols = stash.put(docs.select(*cols), "docs"), ["doc_id", "text", "held_out"]
    return docs.select(*cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", held=None, plain: bool = False) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Null text counts as empty: one end token. Rows that repeat are scored and
    learned from as often as they come. A null doc_id counts as the empty text
    in crc32, and so is held out. Other columns are ignored. An empty table
    gives no rows. ``plain`` says that ``docs`` reads Parquet files as they are,
    so that rows can be told by file and place; others are written first.
    """
    spark = docs.sparkSession
    stash = Stash(spark, "lm")
    held = held if held is not None else crc_mod(F.col(doc_id), 10) == 0
    d = _numbered(stash, docs, doc_id, text, held, plain)
    size = d.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)).alias("b"), F.coalesce(F.sum(F.when(~F.col("held_out"), 1).otherwise(0)), F.lit(0)).alias("train")).first()
    grow = max(1.0, (size.b / 2e12) ** 0.5)
    group_bytes, shard_bytes = min(GROUP_MOST, GROUP_BYTES * grow), min(SHARD_MOST, SHARD_BYTES * grow)
    shards = max(1, int(-(-size.b // shard_bytes)), min(partitions(spark), size.b // 1_000_000))
    per_group = max(1, int(group_bytes * size.n / max(size.b, 1)))
    d = d.withColumn("grp", F.xxhash64("file", F.floor(F.col("row") / per_group)))
    asked = d.select("grp", "row", (~F.col("held_out")).alias("train"), "text").mapInArrow(_requests(shards), "shard int, grp long, lo long, hi long, keys binary, counts binary")
    asked = asked.repartitionById(shards, "shard").sortWithinPartitions("shard")
    told = stash.put(asked.mapInArrow(_answers, "grp long, shard int, lo long, hi long, other binary, totals binary, stats array<long>"), "answers")
    sums = np.zeros(6 * BINS, np.int64)
    for r in told.where("lo is null").select(F.posexplode("stats").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect():  # 6 * BINS rows
        sums[r.i] = r.x
    (n1, t1), (n2, t2), (n3, _) = sums.reshape(3, 2, BINS)
    model = Model(int(size.train), int(t1.sum()), int(n1.sum()), strength(n2[1], n1, t1), strength(n3[1], n2, t2))
    ddl = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    replies = told.where("lo is not null").select("grp", "shard", "lo", "hi", "other", "totals")
    return d.select("grp", "row", "doc_id", "held_out", "text").groupBy("grp").cogroup(replies.groupBy("grp")).applyInPandas(_score(shards, model), ddl)


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all whole documents under a model of those that are not held out."""
    return score(documents(spark, sf_dir), plain=True)
