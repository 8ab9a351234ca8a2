"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

A word gives two units: its lower-cased letters and digits, and its shape (character
classes with repeats collapsed, punctuation kept). Units are hashed into ``BUCKETS``
buckets, each with a fixed sparse ternary index vector of ``DIM`` places. A bucket's
word vector is its index vector plus the direction of the sum of the index vectors met
beside it in all texts; that table has a fixed size whatever the corpus. A document is
the mean vector of its units. A network with one hidden layer is fitted in numpy on at
most ``MAX_LABELLED`` labelled rows (the smallest hashes of their ids), a fifth of them
kept back to choose the temperature that calibrates the probability.

Defined cases: null text counts as empty, whose vector is zero and which is scored like
any other; rows with a null id or a null label are not learned from; with labels of
one class only, or none, every score is the share of label 1 (0.5 without labels);
repeated rows each give a row; an empty table gives an empty result. Only the id, text
and label columns are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultline.llm.arrays import array_rows, summed
from vaultline.llm.text import MEMO_WORDS, slices, texts_frame, texts_of
from vaultline.session import materialize

BUCKETS, DIM, NONZERO, HIDDEN = 4096, 64, 4, 16
MAX_LABELLED = 20_000
_SHAPE = bytes(65 if 65 <= b < 91 else 97 if 97 <= b < 123 or b >= 128 else 48 if 48 <= b < 58 else b for b in range(256))
_NOT_CORE = bytes(b for b in range(128) if not chr(b).isalnum())
_REPEAT = re.compile(rb"(.)\1+", re.S)


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's non-zero entries."""
    rng = np.random.default_rng(7)
    places = np.argsort(rng.random((BUCKETS, DIM)), axis=1)[:, :NONZERO]
    return places, rng.choice([-1.0, 1.0], (BUCKETS, NONZERO))


class _Units(dict):
    """word -> core bucket + BUCKETS * shape bucket, remembered within a fixed size."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO_WORDS:
            self.clear()
        core = word.lower().translate(None, _NOT_CORE)
        shape = _REPEAT.sub(rb"\1", word.translate(_SHAPE))[:16]
        unit = xxhash.xxh3_64_intdigest(core, 1) % BUCKETS + BUCKETS * (xxhash.xxh3_64_intdigest(shape, 2) % BUCKETS)
        self[word] = unit
        return unit


def _units(texts: list[bytes], memo: _Units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Core buckets, shape buckets and words per text."""
    split = [t.split() for t in texts]
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    both = np.fromiter((memo[w] for ws in split for w in ws), np.int64, int(sizes.sum()))
    return both % BUCKETS, both // BUCKETS, sizes


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """The table (BUCKETS x DIM) learned from all texts; tasks' sums are added by Spark."""
    def run(batches):
        places, signs = index_vectors()
        memo, total = _Units(), np.zeros(BUCKETS * DIM)
        for batch in batches:
            for b in slices(batch, "t"):
                core, shape, sizes = _units(texts_of(b, "t"), memo)
                inner = np.ones(len(core), bool)
                inner[np.cumsum(sizes)[sizes > 0] - 1] = False
                left = np.flatnonzero(inner)
                for me, other in ((left, left + 1), (left + 1, left)):
                    for mine in (core, shape):
                        for theirs in (core, shape):
                            at, near = mine[me] * DIM, theirs[other]
                            for k in range(NONZERO):
                                total += np.bincount(at + places[near, k], signs[near, k], BUCKETS * DIM)
        if total.any():
            yield array_rows(total.reshape(64, -1))

    src = texts_frame(docs).select(F.col(text_col).cast("string").alias("t"))
    context = summed(src.mapInArrow(run, "part int, sums binary"), (64, BUCKETS * DIM // 64)).reshape(BUCKETS, DIM)
    places, signs = index_vectors()
    own = np.zeros((BUCKETS, DIM))
    np.put_along_axis(own, places, signs / np.sqrt(NONZERO), 1)
    return (own + context / np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)).astype(np.float32)


def _pooled(texts: list[bytes], vectors: np.ndarray, memo: _Units) -> np.ndarray:
    core, shape, sizes = _units(texts, memo)
    out = np.zeros((len(sizes), DIM), np.float32)
    ends = np.cumsum(sizes)
    for i in np.flatnonzero(sizes).tolist():
        at = slice(ends[i] - sizes[i], ends[i])
        counts = np.bincount(core[at], minlength=BUCKETS) + np.bincount(shape[at], minlength=BUCKETS)
        used = np.flatnonzero(counts)
        out[i] = counts[used].astype(np.float32) @ vectors[used] / (2 * sizes[i])
    return out


def pool(docs: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, vec binary)``: each text's mean unit vector, single precision."""
    def run(batches):
        memo = _Units()
        for batch in batches:
            for b in slices(batch, "t"):
                vecs = _pooled(texts_of(b, "t"), vectors, memo)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([v.tobytes() for v in vecs], pa.binary())], ["id", "vec"])

    src = texts_frame(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "id long, vec binary")


@dataclass
class Network:
    """Two layers and a temperature; ``prior`` alone where there was nothing to learn."""

    prior: float
    weights: list[np.ndarray] | None = None
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -50, 50)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def fit_network(x: np.ndarray, y: np.ndarray, steps: int = 400) -> Network:
    """Adam on the cross-entropy of four fifths of the rows, temperature from the rest."""
    net = Network(float(y.mean()) if len(y) else 0.5)
    if len(np.unique(y)) < 2:
        return net
    rng = np.random.default_rng(11)
    kept = rng.random(len(y)) < 0.2
    if len(np.unique(y[~kept])) < 2:
        kept[:] = False
    net.center, net.scale = x.mean(0), x.std(0) + 1e-3
    w = [rng.normal(0, DIM**-0.5, (DIM, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    net.weights = w
    a, t = (x[~kept] - net.center) / net.scale, y[~kept]
    mean, square = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for k in range(1, steps + 1):
        h = np.tanh(a @ w[0] + w[1])
        d = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -50, 50))) - t) / len(t)
        back = np.outer(d, w[2]) * (1 - h * h)
        grads = [a.T @ back + 1e-4 * w[0], back.sum(0), h.T @ d + 1e-4 * w[2], np.array([d.sum()])]
        for p, g, m, s in zip(w, grads, mean, square):
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= 0.02 * (m / (1 - 0.9**k)) / (np.sqrt(s / (1 - 0.999**k)) + 1e-8)
    if kept.any():
        z = net.logits(x[kept])
        net.temperature = min((2.0**e for e in np.arange(-2, 4.01, 0.1)), key=lambda c: _loss(z / c, y[kept]))
    return net


def _sample(labels: DataFrame, id_col: str, label_col: str, max_labelled: int) -> DataFrame:
    """``(id, y)``: at most ``max_labelled`` labelled ids, those with the smallest hashes."""
    given = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
    return given.where("id is not null and y in (0, 1)").orderBy(F.xxhash64("id"), "id", "y").limit(max_labelled)


def train(pooled: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
          max_labelled: int = MAX_LABELLED) -> Network:
    """Fit on at most ``max_labelled`` of the labelled rows given."""
    rows = (pooled.join(_sample(labels, id_col, label_col, max_labelled), "id").select("id", "vec", "y")
            .orderBy(F.xxhash64("id"), "id", "y", "vec").limit(max_labelled).collect())
    x = np.array([np.frombuffer(bytes(r.vec), np.float32) for r in rows], np.float64).reshape(-1, DIM)
    return fit_network(x, np.array([r.y for r in rows], np.float64))


def score(pooled: DataFrame, net: Network) -> DataFrame:
    """``(id, score)`` per row."""
    def run(batches):
        for b in batches:
            x = np.frombuffer(b"".join(b.column("vec").to_pylist()), np.float32).reshape(-1, DIM)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(net.scores(x.astype(np.float64)))], ["id", "score"])

    return pooled.mapInArrow(run, "id long, score double")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """``(id, score)`` for all rows of ``docs``, learned from the rows of ``labels`` given."""
    pooled = materialize(pool(docs, word_vectors(docs, text_col), id_col, text_col), "quality_pooled")
    return score(pooled, train(pooled, labels, id_col, label_col))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more.

    Texts are scored where they are read; only the labelled sample's are pooled apart.
    """
    vectors = word_vectors(docs, text_col)
    sample = F.broadcast(_sample(labels, id_col, label_col, MAX_LABELLED).select("id").distinct())  # MAX_LABELLED ids at most
    labelled = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).join(sample, "id", "left_semi")
    net = train(pool(labelled, vectors, "id", "text"), labels, id_col, label_col)

    def run(batches):
        memo = _Units()
        for batch in batches:
            for b in slices(batch, text_col):
                keep = net.scores(_pooled(texts_of(b, text_col), vectors, memo).astype(np.float64)) >= threshold
                yield b.filter(pa.array(keep))

    return texts_frame(docs).mapInArrow(run, docs.schema)
