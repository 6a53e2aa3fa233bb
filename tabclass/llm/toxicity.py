"""Toxicity by the nearest labelled examples, with evidence.

A text is a TF-IDF vector over marked terms: words, and stems (the first 4 to 8
characters of longer words), that labelled toxic texts hold more often than clean
ones (chi-squared, one side).  One further term that every text has, of the fixed
weight ORDINARY, stands for ordinary text: with it, the cosine also tells much
evidence from little.  Term frequencies count as 1 + ln tf; document frequencies
are counted over all documents.

The examples, EXAMPLES of each label at most, lie in an inverted index whose lists
are cut into blocks with their greatest weight.  For a text, the lists are ordered
by what they can add to a cosine: the bar (the k-th best so far) parts those that
alone can't reach it; their block maxima reject candidates before the lists are
read.  The cosines of those left are exact, so the neighbours are those of a full
comparison.  The NEIGHBOURS nearest vote with the similarity's power SHARPNESS; a
logistic curve, fitted to the examples' own leave-one-out votes and weighted to the
labels' shares, makes the vote a probability.

Bounded sample: per label, the EXAMPLES distinct texts whose ids have the smallest
hashes (all if fewer).  A text labelled more than once counts as toxic if at least
half of its labels say so, so the model depends on neither order nor copies.

Edge cases: null counts as empty; a text without marked terms gets the score of the
ordinary text.  With no labels of either kind every score is the share of label 1,
with none at all 0.5.  Rows with a null id are scored, but never learned from.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import small_batches
from tabclass.llm.lexical_search import _TERM, _bounds
from tabclass.llm.shingles import _LOWER, text_chunks, word_hashes

#: Distinct labelled texts of each label that the model is fitted on, at most.
EXAMPLES = 3000
#: Marked terms at most, and the least chi-squared (chance passes it for one in some
#: ten million terms) and toxic texts of one.
MAX_TERMS, CHI_SQUARED, LEAST_TEXTS = 4096, 30.0, 3
STEMS = (4, 5, 6, 7, 8)
ORDINARY = 4.0
NEIGHBOURS, SHARPNESS = 15, 4
BLOCK = 64
EVIDENCE = 5
#: Bags whose verdict a task remembers: many texts have the same one or two terms.
REMEMBERED = 4096
#: A bound counts as below the bar by this much, so that rounding loses no neighbour.
SLACK = 1e-9


def term_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, first byte, last byte) of all words and stems of a chunk."""
    first, inside = _bounds(data, offsets)
    lower = _LOWER[data]
    start = np.flatnonzero(first)
    # A word ends where the next byte isn't inside, or begins another row's word.
    closing = inside & ~(np.append(inside[1:], False) & ~np.append(first[1:], False))
    end = np.flatnonzero(closing) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    letters = np.flatnonzero((data & 0xC0) != 0x80)
    letters = np.append(letters, len(data))
    at = np.searchsorted(letters, start)
    parts = [(word_hashes(lower, start, end), row, start, end)]
    for k in STEMS:
        stop = letters[np.minimum(at + k, len(letters) - 1)]
        long = stop < end
        parts.append((word_hashes(lower, start[long], stop[long]) ^ np.uint64(k), row[long], start[long], stop[long]))
    return tuple(np.concatenate(x) for x in zip(*parts))


class Vocabulary:
    """Sorted hashes of the marked terms behind a small bitmap."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.sort(hashes)
        self.seen = np.zeros(1 << 16, dtype=bool)
        self.seen[(self.hashes >> np.uint64(48)).astype(np.int64)] = True

    def find(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``value``, term) of those that are marked."""
        if not len(self.hashes):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.seen[(value >> np.uint64(48)).astype(np.int64)])
        term = np.minimum(np.searchsorted(self.hashes, value[at]), len(self.hashes) - 1)
        hit = self.hashes[term] == value[at]
        return at[hit], term[hit]

    def bags(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list, tuple]:
        """(terms, frequencies) of each row, and the hits (row, term, start, end) in order of appearance."""
        value, row, start, end = term_hashes(data, offsets)
        at, term = self.find(value)
        row, start, end = row[at], start[at], end[at]
        size = max(1, len(self.hashes))
        key, tf = np.unique(row.astype(np.int64) * size + term, return_counts=True)
        cut = np.searchsorted(key // size, np.arange(len(offsets)))
        return [(key[a:b] % size, tf[a:b]) for a, b in zip(cut[:-1], cut[1:])], (row, term, start, end)


class ExampleIndex:
    """Block-max inverted index of unit vectors (terms, weights); the last term is
    the ordinary one."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int) -> None:
        self.n = len(vectors)
        term = np.concatenate([v[0] for v in vectors]).astype(np.int64) if vectors else np.zeros(0, np.int64)
        example = np.repeat(np.arange(self.n), [len(v[0]) for v in vectors])
        weight = np.concatenate([v[1] for v in vectors]) if vectors else np.zeros(0)
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.blocks = []
        for a, b in zip(self.start[:-1], self.start[1:]):
            cuts = np.arange(a, b, BLOCK)
            self.blocks.append((self.example[cuts], np.maximum.reduceat(self.weight, cuts)[: len(cuts)] if b > a else np.zeros(0)))
            if b > a:  # reduceat's last part runs to the end of all lists
                self.blocks[-1][1][-1] = self.weight[cuts[-1] : b].max()
        self.most = np.array([x[1].max() if len(x[1]) else 0.0 for x in self.blocks])
        self.vectors = vectors

    def exact(self, terms: np.ndarray, weights: np.ndarray, examples: np.ndarray) -> np.ndarray:
        """Cosines with these examples, each summed in the order of the text's terms."""
        out = np.zeros(len(examples))
        for t, w in zip(terms, weights):
            a, b = self.start[t], self.start[t + 1]
            at = np.searchsorted(self.example[a:b], examples)
            there = at < b - a
            there[there] = self.example[a:b][at[there]] == examples[there]
            out[there] += w * self.weight[a:b][at[there]]
        return out

    def nearest(self, terms: np.ndarray, weights: np.ndarray, k: int, but: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """(examples, cosines) of the k nearest, without example ``but``; the smaller
        example of equals."""
        bound = weights * self.most[terms]
        order = np.argsort(-bound, kind="stable")
        rest = np.append(np.cumsum(bound[order][::-1])[::-1], 0.0)
        score, seen = np.zeros(self.n), np.zeros(self.n, dtype=bool)
        bar, left = -1.0, None
        for i, o in enumerate(order):
            t, w = terms[o], weights[o]
            a, b = self.start[t], self.start[t + 1]
            if left is None and rest[i] + SLACK < bar:
                left = np.flatnonzero(seen)
            if left is None:
                score[self.example[a:b]] += w * self.weight[a:b]
                seen[self.example[a:b]] = True
                if but >= 0:
                    seen[but] = False
                known = score[seen]
            else:
                left = left[score[left] + rest[i] + SLACK >= bar]
                first, most = self.blocks[t]
                if len(first):
                    block = np.searchsorted(first, left, side="right") - 1
                    may = score[left] + np.where(block >= 0, w * most[np.maximum(block, 0)], 0.0) + rest[i + 1]
                    left, block = left[may + SLACK >= bar], block[may + SLACK >= bar]
                    for j in np.unique(block[block >= 0]):
                        x, y = a + j * BLOCK, min(b, a + (j + 1) * BLOCK)
                        score[self.example[x:y]] += w * self.weight[x:y]
                known = score[left]
            if len(known) >= k:
                bar = max(bar, float(np.partition(known, len(known) - k)[len(known) - k]))
        if left is None:
            left = np.flatnonzero(seen)
        left = left[score[left] + SLACK >= bar]
        cosine = self.exact(terms, weights, left)
        best = np.lexsort((left, -cosine))[:k]
        return left[best], cosine[best]


@dataclass
class Model:
    vocabulary: Vocabulary
    idf: np.ndarray
    index: ExampleIndex
    labels: np.ndarray
    ids: np.ndarray
    prior: float
    curve: tuple[float, float]

    def vector(self, terms: np.ndarray, tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        weight = np.append((1 + np.log(tf)) * self.idf[terms], ORDINARY) if len(terms) else np.array([ORDINARY])
        return np.append(terms, len(self.idf)).astype(np.int64), weight / np.sqrt((weight * weight).sum())

    def vote(self, terms: np.ndarray, weights: np.ndarray, but: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        near, cosine = self.index.nearest(terms, weights, NEIGHBOURS, but)
        power = np.maximum(cosine, 0) ** SHARPNESS
        total = power.sum()
        return (float((power * self.labels[near]).sum() / total) if total > 0 else self.prior), near, cosine

    def probability(self, vote: float) -> float:
        a, b = self.curve
        return float(1 / (1 + np.exp(-(a * _logit(vote) + b))))


def _logit(v):
    v = np.clip(v, 0.01, 0.99)
    return np.log(v / (1 - v))


def fit_curve(votes: np.ndarray, labels: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the vote's logit, by Newton's steps with
    a slight pull to (1, 0)."""
    x = np.stack([_logit(votes), np.ones(len(votes))], axis=1)
    beta, ridge = np.array([1.0, 0.0]), 1.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-(x @ beta)))
        slope = x.T @ (weight * (labels - p)) - ridge * (beta - [1, 0])
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(2)
        step = np.linalg.solve(bend, slope)
        beta = beta + step
        if np.abs(step).max() < 1e-9:
            break
    return float(max(beta[0], 0.0)), float(beta[1])


def _hash_bar(n: int) -> int:
    """The 64-bit hash up to which about twice EXAMPLES of ``n`` rows lie."""
    rate = min(1.0, 2 * EXAMPLES / max(1, n))
    return min((1 << 63) - 1, int(rate * (1 << 64)) - (1 << 63))


def examples(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str, text_col: str, label_col: str) -> tuple[DataFrame, dict[int, int]]:
    """((id, text, y) of the sampled distinct texts, texts' labels in all by label)."""
    known = labels.where(learn).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").cast("double").alias("y"))
    known = known.where("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg((F.avg("y") >= 0.5).cast("int").alias("y"))
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    h = F.xxhash64("id", F.lit("toxicity"))
    drawn = known.where(" OR ".join(["false", *[f"(y = {y} AND xxhash64(id, 'toxicity') <= {_hash_bar(n)}L)" for y, n in total.items()]]))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # ``drawn`` has about 4 * EXAMPLES rows, whatever the tables' sizes.
    found = texts.join(F.broadcast(drawn), "id").withColumn("h", h)
    one = found.groupBy(F.xxhash64("text").alias("t")).agg(F.min(F.struct("h", "id", "text")).alias("m"), (F.avg("y") >= 0.5).cast("int").alias("y"))
    return one.select("m.h", "m.id", "m.text", "y"), total


def train(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """Fit on the rows of ``labels(id, label)`` where ``learn`` holds; None if there
    are none with a text."""
    spark = docs.sparkSession
    sample, total = examples(docs, labels, learn, id_col, text_col, label_col)
    with small_batches(spark):
        cut = sample.select("h", "id", "y").toArrow().sort_by([("h", "ascending"), ("id", "ascending")]).to_pandas()
    chosen = cut.groupby("y").head(EXAMPLES)
    if chosen.empty:
        return None
    prior = total.get(1, 0) / max(1, sum(total.values()))
    keep = spark.createDataFrame(chosen[["id"]])
    sample = sample.join(F.broadcast(keep), "id").select("id", "y", "text")
    n = chosen["y"].value_counts()
    n1, n0 = int(n.get(1, 0)), int(n.get(0, 0))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = batch.column("y").to_numpy()
            for at, data, offsets in text_chunks(batch.column("text")):
                value, row, _, _ = term_hashes(data, offsets)
                order = np.lexsort((row, value))
                value, row = value[order], row[order]
                new = np.ones(len(value), dtype=bool)
                new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
                value, toxic = value[new], y[at + row[new]] == 1
                names, where = np.unique(value, return_inverse=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(np.bincount(where, toxic, len(names)).astype(np.int64)), pa.array(np.bincount(where, ~toxic, len(names)).astype(np.int64))],
                    ["term", "a", "b"],
                )

    with small_batches(spark):
        counts = sample.select("y", "text").mapInArrow(counted, "term long, a long, b long").groupBy("term").agg(F.sum("a").cast("double").alias("a"), F.sum("b").cast("double").alias("b"))
        chi = F.lit(float(n1 + n0)) * F.pow(F.col("a") * (n0 - F.col("b")) - F.col("b") * (n1 - F.col("a")), F.lit(2.0))
        chi = chi / ((F.col("a") + F.col("b")) * (n1 + n0 - F.col("a") - F.col("b")) * float(max(1, n1)) * float(max(1, n0)))
        marked = counts.where((F.col("a") >= LEAST_TEXTS) & (F.col("a") * n0 > F.col("b") * n1)).withColumn("chi", chi)
        # A model parameter: the strongest terms make the vectors.
        marked = marked.where(F.col("chi").isNull() | (F.col("chi") >= CHI_SQUARED)).orderBy(F.col("chi").desc(), "term").limit(MAX_TERMS).select("term").toArrow()
    vocabulary = Vocabulary(marked["term"].to_numpy().astype(np.int64).view(np.uint64))
    size = len(vocabulary.hashes)

    def frequency(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows = np.zeros(size, dtype=np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, data, offsets in text_chunks(batch.column("text")):
                for terms, _ in vocabulary.bags(data, offsets)[0]:
                    df[terms] += 1
        yield pa.RecordBatch.from_arrays([pa.array(np.append(np.arange(size), -1)), pa.array(np.append(df, rows))], ["term", "df"])

    with small_batches(spark):
        texts = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"))
        seen = texts.mapInArrow(frequency, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    count = dict(zip(seen["term"].to_pylist(), seen["df"].to_pylist()))
    idf = np.array([np.log((1 + count.get(-1, 0)) / (1 + count.get(t, 0))) for t in range(size)])

    @F.arrow_udf("struct<term: array<int>, tf: array<int>>")
    def bag(column: pa.Array) -> pa.Array:
        bags = [b for _, d, o in text_chunks(column) for b in vocabulary.bags(d, o)[0]]
        kind = pa.list_(pa.int32())
        return pa.StructArray.from_arrays([pa.array([b[i].astype(np.int32) for b in bags], kind) for i in (0, 1)], ["term", "tf"])

    with small_batches(spark):
        rows = sample.select("id", "y", bag("text").alias("bag")).toArrow().sort_by("id").to_pylist()
    labels_ = np.array([r["y"] for r in rows], dtype=np.float64)
    model = Model(vocabulary, idf, ExampleIndex([], size + 1), labels_, np.array([r["id"] for r in rows]), prior, (1.0, 0.0))
    vectors = [model.vector(np.array(r["bag"]["term"], dtype=np.int64), np.array(r["bag"]["tf"], dtype=np.float64)) for r in rows]
    model.index = ExampleIndex(vectors, size + 1)
    if 0 < labels_.mean() < 1:
        votes = np.array([model.vote(*v, but=i)[0] for i, v in enumerate(vectors)])
        share = labels_.mean()
        model.curve = fit_curve(votes, labels_, np.where(labels_ == 1, prior / share, (1 - prior) / (1 - share)))
    return model


VERDICT = "struct<score: double, near: array<bigint>, similarity: array<double>, toxic: array<int>, evidence: array<string>>"


def scored(model: Model | None, text: Column) -> Column:
    """Struct of a text column: score (0 to 1), the nearest examples with their
    cosines and labels, and the marked terms of the text, the weightiest first."""
    if model is None or not 0 < model.labels.mean() < 1:
        none = F.array().cast("array<bigint>")
        return F.struct(
            F.lit(0.5 if model is None else model.prior).alias("score"), none.alias("near"), F.array().cast("array<double>").alias("similarity"),
            F.array().cast("array<int>").alias("toxic"), F.array().cast("array<string>").alias("evidence"),
        )
    nothing = np.zeros(0, np.int64)
    plain = model.vote(*model.vector(nothing, nothing))

    @F.arrow_udf(VERDICT)
    def score(column: pa.Array) -> pa.Array:
        out, known = [], {}
        for _, data, offsets in text_chunks(column):
            bags, (row, term, start, end) = model.vocabulary.bags(data, offsets)
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(len(offsets)))
            for i, (terms, tf) in enumerate(bags):
                key = terms.tobytes() + tf.tobytes()
                if key not in known and len(known) < REMEMBERED:
                    known[key] = model.vote(*model.vector(terms, tf)) if len(terms) else plain
                vote, near, cosine = known[key] if key in known else model.vote(*model.vector(terms, tf))
                evidence = []
                if len(terms):
                    hits = order[cut[i] : cut[i + 1]]
                    weight = (1 + np.log(tf)) * model.idf[terms]
                    for t in terms[np.argsort(-weight, kind="stable")]:
                        h = hits[np.argmax(term[hits] == t)]
                        stop = int(end[h])
                        while stop < offsets[i + 1] and _TERM[data[stop]]:
                            stop += 1
                        word = data[start[h] : stop].tobytes().decode()
                        if not any(word in e or e in word for e in evidence):
                            evidence.append(word)
                        if len(evidence) == EVIDENCE:
                            break
                out.append(
                    {"score": model.probability(vote), "near": model.ids[near].tolist(), "similarity": cosine.tolist(),
                     "toxic": model.labels[near].astype(int).tolist(), "evidence": evidence}
                )
        kind = pa.struct([("score", pa.float64()), ("near", pa.list_(pa.int64())), ("similarity", pa.list_(pa.float64())), ("toxic", pa.list_(pa.int32())), ("evidence", pa.list_(pa.string()))])
        return pa.array(out, kind)

    return score(F.coalesce(text.cast("string"), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame, learn: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """(doc_id, score, near, similarity, toxic, evidence) of every row of ``docs``."""
    model = train(docs, labels, learn, id_col, text_col, label_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), scored(model, F.col(f"`{text_col}`")).alias("v"))
    return rows.select("doc_id", "v.*")
