"""Text quality by nearest-neighbour voting over latent-semantic vectors.

A document becomes counts of character-class trigrams (runs of one class as one
character, so nothing depends on the language) and of shape terms (how often words,
neighbouring words and lines repeat, how long words are).  Document frequencies
of all terms are counted over all documents.  A bounded, stratified sample of the
labelled rows gives the latent axes (singular vectors of its tf-idf matrix) and the
labelled vectors.  These go to all tasks; every document gets exact cosine products
with all of them in blocks, and its nearest neighbours vote for their label, weighted by
similarity and by how many labelled rows each sampled one stands for.

Defined results: a null, empty or blank text has no terms and no neighbour, its score is
the share of label 1 among the labelled rows; without any usable label every score is
0.5; ties among neighbours go to the larger vote order of the sample, which is sorted by
a hash of the id and then the text; repeated rows are scored row by row; input
columns stay as they are, except one named like the result (replaced).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_column, summed_vectors, text_blocks, texts_of

HASHED = 2039  # trigram terms (a prime)
BUCKETS = 16  # buckets of each shape measure
SHAPES = 7
TERMS = HASHED + BUCKETS * SHAPES
SHARPNESS = 24  # power of the similarity in a vote
SHAPE_WEIGHT = 0.5  # each shape term against the unit length of the trigram part

_MARKS = b".,!?;:'\"-_|*$%#&@/\\()[]{}<>=+~^`"
_CLASS = np.zeros(256, np.int64)  # 0: other bytes below 0x80
for _b in range(256):
    if 97 <= _b <= 122 or _b >= 0x80:
        _CLASS[_b] = 1  # letters, and all bytes of letters beyond ASCII
    elif 65 <= _b <= 90:
        _CLASS[_b] = 2
    elif 48 <= _b <= 57:
        _CLASS[_b] = 3
    elif _b in (9, 32):
        _CLASS[_b] = 4
    elif _b in (10, 13):
        _CLASS[_b] = 5
    elif _b in _MARKS:
        _CLASS[_b] = 6 + _MARKS.index(_b)
_CLASSES = 6 + len(_MARKS)


def shape(text: bytes) -> list[float]:
    """Measures between 0 and 1 of how a text repeats itself and how its words look."""
    words = text.split()
    n = len(words)
    if not n:
        return []
    lines = [x for x in text.split(b"\n") if x.strip()]
    return [
        len(set(words)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        len(set(zip(words, words[1:]))) / max(1, n - 1),
        len(set(lines)) / max(1, len(lines)),
        min(1.0, len(text) / n / 20),
        1 - len(text.translate(None, _MARKS)) / len(text),
        sum(map(bytes.isupper, words)) / n,
    ]


def term_counts(texts: list[bytes]) -> np.ndarray:
    """One row of term counts per text; shape measures are spread over the two nearest buckets."""
    rows = len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    c = _CLASS[np.frombuffer(b"".join(texts), np.uint8)]
    doc = np.repeat(np.arange(rows), lengths)
    if len(c):
        first = np.append(True, (c[1:] != c[:-1]) | (doc[1:] != doc[:-1]))
        c, doc = c[first], doc[first]
    inside = doc[2:] == doc[:-2]
    term = ((c[:-2] * _CLASSES + c[1:-1]) * _CLASSES + c[2:]) % HASHED
    out = np.zeros((rows, TERMS), np.float32)
    if len(term):
        out[:, :HASHED] = np.bincount((doc[:-2] * HASHED + term)[inside], minlength=rows * HASHED).reshape(rows, HASHED)
    for i, t in enumerate(texts):
        for k, v in enumerate(shape(t)):
            at = v * (BUCKETS - 1)
            low = min(int(at), BUCKETS - 2)
            out[i, HASHED + k * BUCKETS + low] = 1 - (at - low)
            out[i, HASHED + k * BUCKETS + low + 1] = at - low
    return out


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray | None  # terms x latent dimensions
    vectors: np.ndarray | None  # labelled rows x latent dimensions, unit length
    labels: np.ndarray | None
    weights: np.ndarray | None
    prior: float
    neighbours: int

    def weighted(self, counts: np.ndarray) -> np.ndarray:
        x = counts.copy()
        tri = np.log1p(x[:, :HASHED]) * self.idf[:HASHED]
        norm = np.sqrt((tri * tri).sum(1, keepdims=True))
        x[:, :HASHED] = tri / np.where(norm > 0, norm, 1)
        x[:, HASHED:] *= SHAPE_WEIGHT
        return x

    def latent(self, counts: np.ndarray) -> np.ndarray:
        v = self.weighted(counts) @ self.axes
        norm = np.sqrt((v * v).sum(1, keepdims=True))
        return v / np.where(norm > 0, norm, 1)

    def score(self, texts: list[bytes]) -> np.ndarray:
        out = np.full(len(texts), self.prior)
        if self.vectors is None:
            return out
        v = self.latent(term_counts(texts))
        near = v @ self.vectors.T  # exact cosines of a block with all labelled rows
        k = min(self.neighbours, math.ceil(math.sqrt(near.shape[1])))
        top = np.argpartition(near, near.shape[1] - k, 1)[:, near.shape[1] - k:]
        sim = np.maximum(np.take_along_axis(near, top, 1), 0).astype(np.float64) ** SHARPNESS
        w = sim * self.weights[top]
        total = w.sum(1)
        some = (total > 0) & (np.abs(v).sum(1) > 0)
        out[some] = (w * self.labels[top]).sum(1)[some] / total[some]
        return np.clip(out, 0, 1)


def document_frequencies(docs: DataFrame, text: str) -> tuple[np.ndarray, float]:
    """In how many of all documents each term occurs, and the number of documents."""

    def partial(batches):
        total = np.zeros(TERMS + 1)
        for block in text_blocks(batches, text):
            x = term_counts(texts_of(block, text))
            total[:-1] += (x > 0).sum(0)
            total[-1] += len(x)
        return total

    total = summed_vectors(docs.select(text), partial, TERMS + 1)
    return total[:-1], total[-1]


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "quality",
        sample: int = 3000, dims: int = 48, neighbours: int = 25) -> Model:
    """Learn from ``labels`` (already without held-out rows); at most ``sample`` labelled rows are kept, half of each class.

    The bound also holds for what is broadcast: ``sample`` x ``dims`` numbers.
    """
    frequency, n_docs = document_frequencies(docs, text)
    idf = (np.log((1 + n_docs) / (1 + frequency)) + 1).astype(np.float32)
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), (F.col(label) > 0).cast("int").alias("_label"))
    totals = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    none = Model(idf, None, None, None, None, 0.5, neighbours)
    if not totals:
        return none
    none.prior = totals.get(1, 0) / sum(totals.values())
    parts = [known.where(F.col("_label") == y).orderBy(F.xxhash64("_key"), "_key").limit(sample // 2) for y in totals]
    chosen = parts[0] if len(parts) == 1 else parts[0].unionAll(parts[1])
    # the sample is bounded by its parameter, so it may be broadcast; texts stay where they are
    rows = (docs.select(F.col(key).alias("_id"), F.col(text).alias("_text"))
            .join(F.broadcast(chosen), F.col("_id") == F.col("_key")).where("_text is not null")
            .select("_label", "_text", F.xxhash64("_key").alias("_h"))
            .mapInArrow(_counts, "_label int, _h long, _t long, _x binary")
            .orderBy("_h", "_t", "_label").limit(2 * sample).collect())
    if not rows:
        return none
    counts = np.stack([_unpacked(r["_x"]) for r in rows])
    y = np.array([r["_label"] for r in rows], np.float64)
    x = none.weighted(counts)
    axes = singular_axes(x, min(dims, *x.shape))
    share = {v: totals[v] / max(1, (y == v).sum()) for v in totals}
    model = Model(idf, axes, None, y, np.array([share[int(v)] for v in y]), none.prior, neighbours)
    model.weights = model.weights / model.weights.max()
    model.vectors = model.latent(counts)
    return model


def _counts(batches):
    for block in text_blocks(batches, "_text"):
        texts = texts_of(block, "_text")
        x = term_counts(texts)
        packed = []
        for row in x:
            at = np.flatnonzero(row)
            packed.append(at.astype(np.uint16).tobytes() + row[at].astype(np.float32).tobytes())
        yield pa.RecordBatch.from_arrays(
            [block.column(0), block.column(2), pa.array([len(t) for t in texts], pa.int64()),
             pa.array(packed, pa.binary())], ["_label", "_h", "_t", "_x"])


def _unpacked(raw: bytes) -> np.ndarray:
    n = len(raw) // 6
    out = np.zeros(TERMS, np.float32)
    out[np.frombuffer(raw[:2 * n], np.uint16)] = np.frombuffer(raw[2 * n:], np.float32)
    return out


def singular_axes(x: np.ndarray, k: int, rounds: int = 4) -> np.ndarray:
    """Leading right singular vectors by subspace iteration from a fixed start."""
    q = np.random.default_rng(7).standard_normal((x.shape[1], min(x.shape[1], k + 8))).astype(np.float32)
    for _ in range(rounds):
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    return np.ascontiguousarray((q @ vt.T)[:, :k], np.float32)


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score",
          keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the column ``out``: 0 to 1, higher where label 1 is likelier."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def fill(block: pa.RecordBatch) -> pa.Array:
        return pa.array(sent.value.score(texts_of(block, text)), pa.float64())

    return add_column(docs, out, T.DoubleType(), fill, text, keep)
