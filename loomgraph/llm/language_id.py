"""Operator 6: language identification with a blended-spectrum string kernel.

The kernel of two texts is the cosine of their sets of character n-grams (n = 1
to 4, presence only, each n with equal weight). Landmark texts span the feature
space (Nystroem): a text is represented by its kernels with the landmarks,
whitened by the landmarks' own kernel matrix, and a one-versus-rest kernel ridge
regression gives a score for each language. Texts are scored in batches by two
matrix products: presence vectors with those of the landmarks, which gives the
kernels, and kernels with the regression's weights.

Training texts are a sample of labelled rows picked by a hash, of about
``PER_LABEL`` rows a language and ``SAMPLE`` in all. What reaches the driver are
their presence vectors as bits, 8 KB each whatever the text's length. The model
that is broadcast is ``LANDMARKS`` such vectors and a weight for each landmark
and language. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.llm._shared import crc_mod, documents

ORDERS = (1, 2, 3, 4)
BUCKETS = 1 << 14
PER_LABEL, SAMPLE = 600, 6000
LANDMARKS = 200
RIDGE = 1e-3
#: Texts in one matrix product.
BATCH = 64
UNKNOWN = "und"

_MUL = np.uint32(0x9E3779B1)


def presence(text: str) -> list[np.ndarray]:
    """Sorted distinct hashed n-grams of the whole text, for each order."""
    u = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    # all that is no letter is one blank; letters are those of str.isalpha, looked up by distinct code point
    points = np.unique(u)
    kept = np.array([chr(p).isalpha() for p in points.tolist()], bool)
    if not kept.all():
        u = np.where(kept[np.searchsorted(points, u)], u, np.uint32(32))
    u = np.concatenate((np.array([32], np.uint32), u, np.array([32], np.uint32)))
    blank = u == 32
    u = u[~(blank & np.concatenate(([False], blank[:-1])))]
    out, h = [], np.zeros(len(u), np.uint32)
    for n in ORDERS:
        if len(u) < n:
            out.append(np.zeros(0, np.int64))
            continue
        h = (h[: len(u) - n + 1] * _MUL) ^ (u[n - 1 :] * np.uint32(0x85EBCA6B) + np.uint32(n))
        x = h ^ (h >> np.uint32(15))
        x = x * np.uint32(0x2C1B3C6D)
        mark = np.zeros(BUCKETS, bool)
        mark[x >> np.uint32(32 - 14)] = True
        out.append(np.flatnonzero(mark) + (n - 1) * BUCKETS)
    return out


DIM = len(ORDERS) * BUCKETS


def bits(text: str) -> bytes:
    """The presence vector, a bit for each feature."""
    mark = np.zeros(DIM, bool)
    for p in presence(text):
        mark[p] = True
    return np.packbits(mark).tobytes()


def matrix(packed: list[bytes]) -> np.ndarray:
    """Unit vectors as rows: orders with any n-gram weigh the same."""
    x = np.unpackbits(np.frombuffer(b"".join(packed), np.uint8).reshape(len(packed), -1), axis=1)
    x = x.reshape(len(packed), len(ORDERS), BUCKETS).astype(np.float32)
    n = x.sum(axis=2, keepdims=True)
    full = (n > 0).sum(axis=1, keepdims=True)
    x /= np.sqrt(np.maximum(n * full, 1))
    return x.reshape(len(packed), DIM)


class Model:
    """Labels, presence vectors of the landmarks, and a weight for each landmark and label."""

    def __init__(self, labels: list[str], landmarks: list[bytes], weights: np.ndarray, bias: np.ndarray):
        self.labels, self.landmarks, self.weights, self.bias = labels, landmarks, weights, bias
        self.columns: np.ndarray | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"columns": None}  # made anew where it is used

    def kernels(self, packed: list[bytes]) -> np.ndarray:
        """Kernel of each text with each landmark, in batches."""
        if self.columns is None:
            self.columns = np.ascontiguousarray(matrix(self.landmarks).T)
        return np.concatenate([matrix(packed[at : at + BATCH]) @ self.columns for at in range(0, len(packed), BATCH)])

    def scores(self, texts: list[str]) -> np.ndarray:
        """One row for each text, one column for each label; regression targets are -1 and 1."""
        return self.kernels([bits(t) for t in texts]).astype(float) @ self.weights + self.bias


def train(packed: list[bytes], labels: list[str], landmarks: int = LANDMARKS, ridge: float = RIDGE, seed: int = 5) -> Model:
    """Kernel ridge regression on Nystroem features of ``landmarks`` presence vectors."""
    names = sorted(set(labels))
    if not names:
        return Model([], [], np.zeros((0, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    by = {n: [i for i, y in enumerate(labels) if y == n] for n in names}
    share = max(1, landmarks // len(names))
    chosen = [i for n in names for i in sorted(rng.permutation(by[n])[:share].tolist())]
    model = Model(names, [packed[i] for i in chosen], np.zeros((len(chosen), len(names))), np.zeros(len(names)))
    k_nm = model.kernels(packed).astype(float)
    k_mm = k_nm[chosen]
    val, vec = np.linalg.eigh((k_mm + k_mm.T) / 2)
    good = val > 1e-6 * val[-1]
    white = vec[:, good] / np.sqrt(val[good])
    phi = k_nm @ white
    y = np.array([[1.0 if t == n else -1.0 for n in names] for t in labels])
    # every label weighs the same, whatever its number of rows
    weight = np.array([1 / len(by[t]) for t in labels])[:, None]
    weight /= weight.mean()
    mean_x, mean_y = (weight * phi).mean(axis=0), (weight * y).mean(axis=0)
    px, py = phi - mean_x, y - mean_y
    beta = np.linalg.solve(px.T @ (weight * px) / len(phi) + ridge * np.eye(px.shape[1]), px.T @ (weight * py) / len(phi))
    model.weights, model.bias = white @ beta, mean_y - mean_x @ beta
    return model


def has_letter(text: str | None) -> bool:
    """Whether some character is a letter as ``str.isalpha`` has it."""
    return bool(text) and any(map(str.isalpha, text))


def _sampled(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for big in it:
        for at in range(0, big.num_rows, 100):
            b = big.slice(at, 100)
            rows = [(bits(t), y, o) for t, y, o in zip(*(b.column(i).to_pylist() for i in range(3))) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.binary(), pa.string(), pa.int64()))], names=["x", "y", "o"])


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id", per_label: int = PER_LABEL, sample: int = SAMPLE) -> Model:
    """A model of a bounded sample of the rows with a label and a letter.

    Labels are counted over all rows first. Should there be so many that
    ``sample`` rows cannot hold ``per_label`` of each, all get fewer; with more
    labels than ``sample`` a ValueError asks for a larger one.
    """
    rows = docs.where(F.col(label).isNotNull() & F.col(text).rlike(r"\p{L}")).select(F.col(key).cast("string").alias("k"), F.col(text).alias("t"), F.col(label).cast("string").alias("y"))
    counts = {r.y: r.n for r in rows.groupBy("y").agg(F.count("*").alias("n")).limit(sample + 1).collect()}
    if len(counts) > sample:
        raise ValueError(f"more than {sample} labels: raise sample")
    if not counts:
        return train([], [])
    each = max(1, min(per_label, sample // len(counts)))
    u = F.pmod(F.xxhash64(F.lit("sample"), "k", F.length("t")), F.lit(1_000_000)) / 1_000_000.0
    rate = F.create_map(*[F.lit(x) for y, n in sorted(counts.items()) for x in (y, min(1.0, 1.5 * each / n + 20 / n))])
    picked = rows.where(u < F.element_at(rate, F.col("y"))).select("t", "y", F.xxhash64("k", "t").alias("o")).limit(2 * sample + 40 * len(counts))
    got = sorted(((r.o, r.x, r.y) for r in picked.mapInArrow(_sampled, "x binary, y string, o long").collect()), key=lambda r: (r[2], r[0]))
    taken: dict[str, int] = {}
    packed, labels = [], []
    for _, x, y in got:
        if taken.get(y, 0) < each:
            taken[y] = taken.get(y, 0) + 1
            packed.append(bytes(x))
            labels.append(y)
    return train(packed, labels)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``: ``und`` and 0 without text, letter or learned label.

    Clashing columns of ``docs`` give way; all others stay as they are. Texts of
    any length become one vector of fixed size.
    """
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)  # of bounded size: LANDMARKS vectors of 8 KB (one a label at least) and their weights
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    src = docs.select(*kept, F.col(text).cast("string").alias("_loom_text"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for big in it:
            for at in range(0, big.num_rows, 500):
                b = big.slice(at, 500)
                texts = b.column(b.num_columns - 1).to_pylist()
                ask = [i for i, t in enumerate(texts) if m.labels and has_letter(t)]
                lang, score = [UNKNOWN] * len(texts), [0.0] * len(texts)
                if ask:
                    s = m.scores([texts[i] for i in ask])
                    # regression targets are -1 and 1
                    prob = np.clip((s + 1) / 2, 0.0, 1.0)
                    for i, j, p in zip(ask, s.argmax(axis=1).tolist(), prob.max(axis=1).tolist()):
                        lang[i], score[i] = m.labels[j], p
                cols = [b.column(i) for i in range(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(lang, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names[:-1], "lang_pred", "score"])

    schema = src.drop("_loom_text").schema.add("lang_pred", "string").add("score", "double")
    return src.mapInArrow(run, schema)


def held_out(key: str = "doc_id"):
    return crc_mod(F.col(key), 5) == 0


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A predicted language for every document, learned from those that are not held out.

    Null text and text without a letter give ``und``. A null label is not
    learned from. A null doc_id counts as the empty text in crc32, and so is
    held out. Rows that repeat get the same prediction.
    """
    docs = documents(spark, sf_dir)
    model = fit(docs.where(~held_out()))
    d = docs.select("doc_id", held_out().alias("held_out"), "text")
    return predict(d, model).select("doc_id", "held_out", "lang_pred", "score")
