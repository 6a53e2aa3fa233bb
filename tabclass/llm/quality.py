"""Quality by nearest-neighbour voting among latent-semantic vectors.

A text is a bag of hashed words, word shapes and repeats, weighted by inverse
document frequency and projected on the leading singular vectors of a bounded
sample of labelled texts.  The sample's vectors and labels are broadcast (their
size is fixed by the parameters); every document's cosine with each of them is
computed exactly, in blocks, and its nearest neighbours vote with weights that
grow with the similarity.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.shingles import _LOWER, text_chunks, word_hashes, words

#: Labelled rows that the vectors are taken from, at most.
SAMPLE_ROWS = 3000
LATENT = 48
NEIGHBOURS = 15
SHARPNESS = 8
WORD_BUCKETS, SHAPE_BUCKETS, OTHER = 2048, 960, 64
WIDTH = WORD_BUCKETS + SHAPE_BUCKETS + OTHER
BLOCK = 512

_KIND = np.arange(256, dtype=np.uint8)
_KIND[48:58] = 1
_KIND[65:91] = 2
_KIND[97:123] = 3
_KIND[128:] = 3


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x WIDTH: shares of hashed words, of shapes (classes of characters,
    repeats collapsed), and of word lengths, word repeats and line breaks."""
    n_rows = len(offsets) - 1
    out = np.zeros((n_rows, WIDTH), dtype=np.float32)
    start, end, row = words(data, offsets)
    if len(start) == 0:
        return out
    n = np.maximum(1, np.bincount(row, minlength=n_rows)).astype(np.float32)[:, None]
    kind = _KIND[data]
    fresh = np.ones(len(data), dtype=bool)
    fresh[1:] = kind[1:] != kind[:-1]
    fresh[start] = True
    at = np.concatenate([[0], np.cumsum(fresh)])
    shape = word_hashes(kind[fresh], at[start], at[end])
    word = word_hashes(_LOWER[data], start, end)
    again = np.zeros(len(word), dtype=bool)
    again[1:] = (word[1:] == word[:-1]) & (row[1:] == row[:-1])

    def share(bucket: np.ndarray, size: int) -> np.ndarray:
        return np.bincount(row * size + bucket, minlength=n_rows * size).reshape(n_rows, size) / n

    out[:, :WORD_BUCKETS] = share((word % np.uint64(WORD_BUCKETS)).astype(np.int64), WORD_BUCKETS)
    out[:, WORD_BUCKETS : WORD_BUCKETS + SHAPE_BUCKETS] = share((shape % np.uint64(SHAPE_BUCKETS)).astype(np.int64), SHAPE_BUCKETS)
    length = np.minimum(end - start, 24)
    out[:, WORD_BUCKETS + SHAPE_BUCKETS :] = share(np.where(again, 32, length), OTHER)
    return np.sqrt(out)


@dataclass
class Model:
    weight: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, x: np.ndarray) -> np.ndarray:
        z = (x * self.weight) @ self.axes
        return z / np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Weighted share of neighbours with label 1; a text without words gets
        the share of label 1 in the sample."""
        out = np.full(len(x), self.prior)
        for a in range(0, len(x), BLOCK):
            part = x[a : a + BLOCK]
            cosine = self.latent(part) @ self.vectors.T
            k = min(NEIGHBOURS, cosine.shape[1])
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            total = weight.sum(axis=1)
            some = (total > 1e-12) & (part.sum(axis=1) > 0)
            out[a : a + BLOCK][some] = (weight * self.labels[near]).sum(axis=1)[some] / total[some]
        return np.clip(out, 0, 1)


def fit(x: np.ndarray, labels: np.ndarray, seed: int = 5) -> Model:
    """Latent axes by a randomised singular value decomposition."""
    df = (x > 0).sum(axis=0)
    weight = np.log((1 + len(x)) / (1 + df)).astype(np.float32) + 1
    weight[WORD_BUCKETS:] *= 2
    a = x * weight
    rng = np.random.default_rng(seed)
    k = min(LATENT, *a.shape)
    q = a.T @ (a @ rng.normal(size=(a.shape[1], k + 8)).astype(np.float32))
    for _ in range(3):
        q = a.T @ (a @ np.linalg.qr(q)[0])
    q = np.linalg.qr(q)[0]
    _, _, v = np.linalg.svd(a @ q, full_matrices=False)
    axes = (q @ v[:k].T).astype(np.float32)
    model = Model(weight, axes, np.zeros((0, k), np.float32), labels.astype(np.float64), float(labels.mean()))
    model.vectors = model.latent(x).astype(np.float32)
    return model


def hash_bar(n: int) -> int:
    """The 64-bit hash up to which about 0.9 * SAMPLE_ROWS of ``n`` rows lie."""
    rate = min(1.0, 0.9 * SAMPLE_ROWS / n)
    return min((1 << 63) - 1, int(rate * (1 << 64)) - (1 << 63))


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model | None:
    """Fit on a sample of the rows of ``labels(id, label)`` where ``learn``
    holds: the ids with the smallest hashes, SAMPLE_ROWS at most, with the smallest
    (by hash) of each id's texts, whole.  An id labelled more than once counts as 1
    if at least half of its labels are 1.  So the sample depends neither on the rows'
    order nor on copies of labels or documents.  None if no labelled row has a text."""
    known = labels.where(learn).select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y")).where("id IS NOT NULL AND y IS NOT NULL")
    known = known.groupBy("id").agg((F.avg("y") >= 0.5).cast("double").alias("y"))
    n = known.count()
    if n == 0:
        return None
    h = F.xxhash64(F.col("id"), F.lit("quality"))
    drawn = known.where(h <= hash_bar(n)).orderBy(h, "id").limit(SAMPLE_ROWS)

    @F.arrow_udf("binary")
    def bag(text: pa.Array) -> pa.Array:
        return pa.array([r.tobytes() for _, d, o in text_chunks(text) for r in features(d, o)], pa.binary())

    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    one = texts.join(F.broadcast(drawn), "id").groupBy("id", "y").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t"))
    sample = one.select("id", "y", bag("t.text").alias("x")).toArrow().sort_by("id")
    if sample.num_rows == 0:
        return None
    x = np.frombuffer(b"".join(sample["x"].to_pylist()), dtype=np.float32).reshape(sample.num_rows, WIDTH)
    return fit(x, sample["y"].to_numpy())


def scored(model: Model | None, text: Column) -> Column:
    """Score (0 to 1) of a text column; null counts as empty, and 0.5 if nothing
    could be learned."""
    if model is None:
        return F.lit(0.5)

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        parts = [model.score(features(d, o)) for _, d, o in text_chunks(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0))

    return score(text)
