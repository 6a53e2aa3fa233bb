"""Language identification by averaged hashed subword embeddings.

A text is the average of the embeddings of its byte 2-, 3- and 4-grams, hashed
to a fixed number of rows; a linear softmax on top gives the languages.  Both
layers are trained by stochastic gradient descent in numpy on a bounded sample
of labelled rows.  A part of the sample calibrates: it sets the softmax
temperature and the probability below which a prediction is rejected.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import pick
from tabclass.llm.shingles import text_chunks

#: Distinct labelled texts per language that the model is fitted on.
ROWS_PER_LANG = 250
BUCKET_BITS = 12
DIM = 16
EPOCHS = 60
#: Share of the calibration rows that may be rejected, and the highest bar.
REJECT_SHARE = 0.001
HIGHEST_BAR = 0.4
UNKNOWN = "und"

_FOLD = np.full(256, 32, dtype=np.uint8)  # what is no letter becomes a space
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def gram_counts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x buckets: counts of the hashed subwords of each text, in any case.
    Grams lie within a word and the one space before and after it."""
    n_rows, width = len(offsets) - 1, 1 << BUCKET_BITS
    folded = _FOLD[data]
    if len(data) > 1:  # accented Latin capitals
        second = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E)) + 1
        folded[second] += 0x20
    row = np.repeat(np.arange(n_rows, dtype=np.int64), np.diff(offsets))
    text = folded.astype(np.uint32)
    blank = folded == 32
    flat = []
    for size in (2, 3, 4):
        m = len(text) - size + 1
        if m <= 0:
            continue
        gram = text[:m].copy()
        for j in range(1, size):
            gram = gram * np.uint32(257) + text[j : m + j]
        ok = row[:m] == row[size - 1 :]
        if size == 2:
            ok &= ~(blank[:m] & blank[1:])
        for j in range(1, size - 1):
            ok &= ~blank[j : m + j]
        gram = (gram * np.uint32(0x9E3779B1) + np.uint32(size * 0x85EBCA6B & 0xFFFFFFFF)) >> np.uint32(32 - BUCKET_BITS)
        flat.append((row[:m] * width + gram)[ok])
    if not flat:
        return np.zeros((n_rows, width), dtype=np.float32)
    return np.bincount(np.concatenate(flat), minlength=n_rows * width).reshape(n_rows, width).astype(np.float32)


def averaged(counts: np.ndarray) -> np.ndarray:
    total = counts.sum(axis=1, keepdims=True)
    return counts / np.maximum(total, 1)


def _softmax(z: np.ndarray) -> np.ndarray:
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return z / z.sum(axis=1, keepdims=True)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # bucket x language: embedding times output layer, tempered
    bias: np.ndarray
    bar: float

    def probabilities(self, counts: np.ndarray) -> np.ndarray:
        return _softmax(averaged(counts) @ self.table + self.bias)


def fit(x: np.ndarray, langs: list[str], seed: int = 7) -> Model:
    """Train on rows of averaged counts.  Every fifth row calibrates."""
    names = sorted(set(langs))
    y = np.array([names.index(v) for v in langs])
    rng = np.random.default_rng(seed)
    k = len(names)
    embed = rng.normal(0, 0.5, (x.shape[1], DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, k), np.float32), np.zeros(k, np.float32)
    held = np.arange(len(y)) % 5 == 0 if len(y) >= 20 * k else np.zeros(len(y), bool)
    train = np.flatnonzero(~held)
    step_e, step_o, step_b = np.zeros_like(embed), np.zeros_like(out), np.zeros_like(bias)
    for epoch in range(EPOCHS):
        rate = 1.0 * (1 - epoch / EPOCHS)
        for part in np.array_split(rng.permutation(train), max(1, len(train) // 32)):
            xb = x[part] * 10  # averages are small
            h = xb @ embed
            p = _softmax(h @ out + bias)
            p[np.arange(len(part)), y[part]] -= 1
            p /= len(part)
            step_e = 0.9 * step_e - rate * (xb.T @ (p @ out.T))
            step_o = 0.9 * step_o - rate * (h.T @ p)
            step_b = 0.9 * step_b - rate * p.sum(axis=0)
            embed, out, bias = embed + step_e, out + step_o, bias + step_b
    table = (embed @ out) * 10
    cal = np.flatnonzero(held) if held.any() else train
    z = x[cal] @ table + bias
    scales = np.geomspace(0.05, 4, 60)
    loss = [-np.log(_softmax(z * s)[np.arange(len(cal)), y[cal]] + 1e-12).mean() for s in scales]
    scale = np.float32(scales[int(np.argmin(loss))])
    best = _softmax(z * scale).max(axis=1)
    bar = min(HIGHEST_BAR, float(np.quantile(best, REJECT_SHARE)))
    return Model(names, (table * scale).astype(np.float32), (bias * scale).astype(np.float32), bar)


def _smallest_hashes(rows: DataFrame, n: dict[str, int]) -> dict[str, int]:
    """For each language of ``rows(lang, h)`` its ROWS_PER_LANG-th smallest
    distinct hash, or the largest if there are fewer.  ``n`` estimates the distinct
    hashes: twice as many as needed are drawn, and again if that was too few."""
    rates = {lang: min(1.0, 2 * ROWS_PER_LANG / max(1, c)) for lang, c in n.items()}
    bars: dict[str, int] = {}
    while rates:
        upto = {lang: min((1 << 63) - 1, int(rate * (1 << 64)) - (1 << 63)) for lang, rate in rates.items()}
        limit = F.create_map(*[F.lit(v) for pair in upto.items() for v in pair])
        found: dict[str, list[int]] = {lang: [] for lang in rates}
        for r in rows.where(F.col("h") <= limit[F.col("lang")]).select("lang", "h").distinct().collect():
            found[r["lang"]].append(r["h"])
        for lang, hashes in found.items():
            if len(hashes) >= ROWS_PER_LANG or rates[lang] == 1:
                bars[lang] = sorted(hashes)[:ROWS_PER_LANG][-1]
        rates = {lang: min(1.0, 4 * rate) for lang, rate in rates.items() if lang not in bars}
    return bars


def train(docs: DataFrame, learn: Column, text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on a sample of the rows of ``docs`` where ``learn`` holds: of each
    language the ROWS_PER_LANG distinct texts with the smallest hashes, or all if
    there are fewer, each text whole.  The sample depends on the set of labelled
    texts alone, not on their order or copies.  None if no row has a label.  The
    number of languages is taken to be small; it is the number of classes."""
    rows = docs.where(learn).select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL").withColumn("h", F.xxhash64("text", F.lit("language")))
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("n")).collect()}
    if not n:
        return None
    bars = _smallest_hashes(rows, n)
    bar = F.create_map(*[F.lit(v) for pair in bars.items() for v in pair])

    @F.arrow_udf("binary")
    def features(text: pa.Array) -> pa.Array:
        return pa.array([r.tobytes() for _, d, o in text_chunks(text) for r in averaged(gram_counts(d, o))], pa.binary())

    drawn = rows.where(F.col("h") <= bar[F.col("lang")]).groupBy("lang", "h").agg(F.min("text").alias("text"))
    sample = drawn.select("lang", features("text").alias("x"), F.xxhash64("text").alias("h")).toArrow()
    sample = sample.sort_by([("h", "ascending"), ("lang", "ascending")])
    x = np.frombuffer(b"".join(sample["x"].to_pylist()), dtype=np.float32).reshape(sample.num_rows, -1)
    return fit(x, sample["lang"].to_pylist())


def predicted(model: Model | None, text: Column) -> Column:
    """Struct (lang, score, rejected) of a text column.  A text that is null or
    has no letter is ``und`` with score 0 and is rejected; so is every text if
    nothing could be learned."""

    @F.arrow_udf("struct<lang: string, score: double>")
    def best(column: pa.Array) -> pa.Array:
        where, score = [], []
        for _, data, offsets in text_chunks(column):
            p = model.probabilities(gram_counts(data, offsets))
            where.append(p.argmax(axis=1))
            score.append(p.max(axis=1))
        names = pa.array(model.langs, pa.string()).take(pa.array(np.concatenate(where))) if where else pa.array([], pa.string())
        values = pa.array(np.concatenate(score).astype(np.float64)) if score else pa.array([], pa.float64())
        return pa.StructArray.from_arrays([names, values], ["lang", "score"])

    lettered = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    nothing = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    if model is None:
        return nothing
    found = best(text)
    return F.when(
        lettered, F.struct(found["lang"].alias("lang"), found["score"].alias("score"), (found["score"] < F.lit(model.bar)).alias("rejected"))
    ).otherwise(nothing)


def language_id(docs: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(doc_id, lang_pred, score, rejected) of every row of ``docs``, predicted
    from the text alone by a model trained on the rows where ``learn`` holds."""
    model = train(docs, learn, text_col, lang_col)
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("v", predicted(model, F.col("text")))
    return rows.select("doc_id", F.col("v.lang").alias("lang_pred"), F.col("v.score").alias("score"), F.col("v.rejected").alias("rejected"))
