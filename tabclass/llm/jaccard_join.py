"""N-gram Jaccard self-join by adaptive multi-match prefixes.

Two documents link when the Jaccard similarity of their sets of 5-word shingles
is at least 75/100.  Documents with equal sets form one *class*, joined once.

Prefix rule.  All shingles are put in one global order, shingles known to be
frequent last.  A set of n shingles that reaches 75 % with some other shares at
least t = ceil(0.75 n) shingles with it, so for any l <= t the first
n - t + l shingles of both sets have at least l in common.  A class estimates
what l = 1 would cost it (how often its frequent prefix shingles occur) and
takes a longer prefix, with a larger l, the more candidates it would meet.  Two
classes of n and n' shingles that link share o = ceil(0.75 (n + n') / 1.75) at
least, so both have l of them among their first n - o + l and n' - o + l: two
classes are compared only when they share min(l, l') shingles of those parts of
their prefixes, at positions that leave room for the similarity.  The smaller
class of a pair needs no more than its first n - ceil(1.5 n / 1.75) + l.
Order and l change the work, never the result.

Candidates are verified on whole texts.  Within the postings of a shingle the
class with the largest share of frequent shingles is the hub; hub pairs come
first, and pairs within a component so found are not enumerated again.  All
other candidate pairs follow, so no link between components is lost.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import discard, hash_filter, in_filter, pick, saved
from tabclass.llm.components import connected_components
from tabclass.llm.shingles import text_chunks, text_shingles

WORDS = 5
#: Similarity as a fraction of integers, so that the test is exact.
NUM, DEN = 75, 100
#: A shingle is frequent if the classes of single tasks that hold it add up to this.
FREQUENT = 3
#: Frequent shingles kept for the global order (they only steer the cost).
ORDER_SIZE = 1 << 19
#: Estimated postings that a class may meet before its prefix is lengthened,
#: and how many times as many for each further shingle.  A shingle more in the
#: prefix costs a row for each pair that meets in it, so it must save many.
FREE_COST, COST_STEP = 256, 8
#: Shingles that one task holds before it counts them.
COUNT_BLOCK = 4_000_000

_HALF = np.uint64(1 << 63)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _row_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingles of a chunk, row starts, and class of each row."""
    value, row = text_shingles(data, offsets, WORDS)
    n_rows = len(offsets) - 1
    n = np.bincount(row, minlength=n_rows)
    start = np.concatenate([[0], np.cumsum(n)])
    mixed = value * np.uint64(0x9E3779B97F4A7C15) ^ (value >> np.uint64(29))
    total = np.zeros(len(value) + 1, dtype=np.uint64)
    np.cumsum(mixed * mixed + value, out=total[1:])
    return value, start, _signed(total[start[1:]] - total[start[:-1]])


def _classes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, cls, n, null) of documents, and rows (null, shingle, null,
    count) of shingles that several classes of this task hold."""
    seen: set[tuple[int, int]] = set()
    held: list[np.ndarray] = []
    size = 0

    def frequent() -> pa.RecordBatch:
        every = np.concatenate(held)
        held.clear()
        every.sort()
        at = np.flatnonzero(np.concatenate([[True], every[1:] != every[:-1]]))
        count = np.diff(at, append=len(every))
        value, count = every[at[count > 1]], count[count > 1]
        none = pa.nulls(len(value), pa.int64())
        return pa.record_batch([none, pa.array(_signed(value)), none, pa.array(count.astype(np.int64))], names=["doc_id", "cls", "n", "count"])

    for batch in batches:
        ids = batch.column(0)
        for first, data, offsets in text_chunks(batch.column(1)):
            value, start, cls = _row_sets(data, offsets)
            n = np.diff(start)
            yield pa.record_batch(
                [ids.slice(first, len(n)), pa.array(cls), pa.array(n), pa.nulls(len(n), pa.int64())],
                names=["doc_id", "cls", "n", "count"],
            )
            fresh = np.zeros(len(n), dtype=bool)
            for i, key in enumerate(zip(cls.tolist(), n.tolist())):
                if key not in seen:
                    seen.add(key)
                    fresh[i] = True
            held.append(value[np.repeat(fresh, n)])
            size += len(held[-1])
            if size > COUNT_BLOCK:
                yield frequent()
                size = 0
    if size:
        yield frequent()


def prefix(tokens: np.ndarray, common: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, int, int]:
    """Prefix of one sorted set in global order, the class's level l, and its
    share of frequent shingles in 1/1000.  ``common`` is sorted, ``counts``
    goes with it."""
    n = len(tokens)
    share = 0
    cost = np.zeros(n, dtype=np.int64)
    if len(common):
        at = np.minimum(np.searchsorted(common, tokens), len(common) - 1)
        known = common[at] == tokens
        if known.any():
            cost = np.where(known, counts[at], 0)
            share = int(known.sum() * 1000 // n)
            tokens, cost = (x[np.argsort(cost, kind="stable")] for x in (tokens, cost))
    must = -(-n * NUM // DEN)
    base = n - must
    alike = n + (-2 * n * NUM) // (NUM + DEN)  # as far as a partner of the same size needs
    level = 1 + int(np.log(1 + int(cost[: alike + 1].sum()) / FREE_COST) / np.log(COST_STEP))
    level = max(1, min(level, must))
    return tokens[: base + level], level, share


def _postings(common: np.ndarray, counts: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, data, offsets in text_chunks(batch.column(0)):
                value, start, cls = _row_sets(data, offsets)
                parts: list[tuple] = []
                for i in range(len(cls)):
                    n = int(start[i + 1] - start[i])
                    if n == 0 or (int(cls[i]), n) in seen:
                        continue
                    seen.add((int(cls[i]), n))
                    tokens, level, share = prefix(value[start[i] : start[i + 1]], common, counts)
                    parts.append((tokens, int(cls[i]), (n << 20) + (share << 8) + level))
                if not parts:
                    continue
                tokens = np.concatenate([p[0] for p in parts])
                size = [len(p[0]) for p in parts]
                at = np.searchsorted(common, tokens) if len(common) else np.zeros(len(tokens), np.int64)
                known = common[np.minimum(at, len(common) - 1)] == tokens if len(common) else np.zeros(len(tokens), bool)
                pos = np.concatenate([np.arange(k, dtype=np.int32) for k in size])
                yield pa.record_batch(
                    [
                        pa.array(_signed(tokens)),
                        pa.array(np.repeat(np.array([p[1] for p in parts], dtype=np.int64), size)),
                        pa.array(np.repeat(np.array([p[2] for p in parts], dtype=np.int64), size)),
                        pa.array(pos),
                        pa.array(known),
                    ],
                    names=["tok", "cls", "head", "pos", "known"],
                )

    return run


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a, b, text_a, text_b) -> (a, b) of those that link."""

    def sets(column: pa.Array, ids: np.ndarray) -> list[np.ndarray]:
        different, where = np.unique(ids, return_inverse=True)
        first = np.zeros(len(different), np.int64)
        first[where[::-1]] = np.arange(len(ids))[::-1]
        out: list[np.ndarray] = []
        for _, data, offsets in text_chunks(column.take(pa.array(first))):
            value, row = text_shingles(data, offsets, WORDS)
            out += np.split(value, np.searchsorted(row, np.arange(1, len(offsets) - 1)))
        return [out[i] for i in where]

    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            batch = whole.slice(at, 256)
            a, b = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            good = np.zeros(len(a), dtype=bool)
            for i, (x, y) in enumerate(zip(sets(batch.column(2), a), sets(batch.column(3), b))):
                both = len(np.intersect1d(x, y, assume_unique=True))
                good[i] = DEN * both >= NUM * (len(x) + len(y) - both)
            yield pa.record_batch([pa.array(a[good]), pa.array(b[good])], names=["a", "b"])


def _with_class(bitmap: np.ndarray):
    """Rows (hash of the id, text) -> (cls, n, text) of those whose id may be in
    the bitmap.  Looked up here, not in a UDF before: a second Python step would
    hold a second worker for each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hit = in_filter(bitmap, batch.column(0).to_numpy(zero_copy_only=False))
            text = batch.column(1).filter(pa.array(hit))
            for first, data, offsets in text_chunks(text):
                _, start, cls = _row_sets(data, offsets)
                yield pa.record_batch([pa.array(cls), pa.array(np.diff(start)), text.slice(first, len(cls))], names=["cls", "n", "text"])

    return run


#: What both sides of a posting join carry.
_SIDE = ("cls", "n", "l", "pos", "band", "m")

def _must(size: str) -> str:
    """Least overlap of a set of that size, in SQL."""
    return f"cast(ceil({size} * {NUM} / {DEN}) AS int)"


#: Shingles that two linked sets share at least.
_BOTH = f"cast(ceil({NUM} * (nA + nB) / {NUM + DEN}) AS int)"

#: The least l for which a shared shingle lies in the parts of both prefixes
#: that must have l shingles in common.
_LEVEL = f"greatest(1, posA + 1 + {_BOTH} - nA, posB + 1 + {_BOTH} - nB)"

#: Prefix shingles that both sides share at least: the set whose prefix ends
#: first in the global order has n - prefix shingles after it, no more.
_LEAST = f"{_BOTH} - greatest({_must('nA')} - lA, {_must('nB')} - lB)"

#: The sizes must allow the similarity.  Of a shared shingle at positions i and
#: j at most min(i, j) come before it in both orders, and at most
#: min(n - i, n' - j) - 1 after it.  And m, the number of a class's prefix
#: shingles that any other class holds, limits what two classes share.
_POSSIBLE = (
    "at = greatest(bandA, bandB)"
    f" AND {DEN} * least(nA, nB) >= {NUM} * greatest(nA, nB)"
    f" AND {DEN + NUM} * (least(posA, posB) + least(nA - posA, nB - posB)) >= {NUM} * (nA + nB)"
    f" AND least(mA, mB) >= {_LEAST}"
)


def _side(df: DataFrame, side: str) -> list:
    return [df[c].alias(c + side) for c in _SIDE]


def _counted(rows: DataFrame) -> DataFrame:
    """Rows of two postings (sides A and B) of one shingle to (a, b, shared):
    pairs that share as many shingles as the lower of their levels asks, and
    how many of the prefixes' shingles they share in these rows."""
    need = F.least("lA", "lB")
    return (
        rows.groupBy(F.col("clsA").alias("a"), F.col("clsB").alias("b"), need.alias("need"))
        .agg(F.count("*").alias("shared"), F.count_if(F.expr(_LEVEL) <= need).alias("matches"))
        .where("matches >= need")
        .select("a", "b", "shared")
    )


def _texts(rows: DataFrame, pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """(cls, text) of the classes in ``pairs``, one text each."""
    chosen = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes, "cls")
    chosen = saved(chosen.select("cls", "n", "rep"), "jaccard-chosen")
    bitmap = hash_filter(chosen.select(F.xxhash64("rep")))
    near = rows.select(F.xxhash64("doc_id"), "text").mapInArrow(_with_class(bitmap), "cls long, n long, text string")
    out = saved(near.join(chosen.select("cls", "n"), ["cls", "n"], "left_semi").dropDuplicates(["cls", "n"]), "jaccard-texts")
    discard(chosen)
    return out


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    with_b = pairs.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("text_b")), "b")
    with_a = with_b.join(texts.select(F.col("cls").alias("a"), F.col("text").alias("text_a")), "a")
    return with_a.select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a long, b long")


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``.

    Null and blank texts have no shingles and are their own component, as is
    every text that links with none.  Rows with equal texts share a component,
    also when their ids repeat.  A row whose id is null has a null component
    unless it links with one that has an id.  Other columns are ignored.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    first = saved(rows.mapInArrow(_classes, "doc_id long, cls long, n long, count long"), "jaccard-classes")
    members = first.where("count IS NULL").select("doc_id", "cls", "n")
    classes = saved(members.where("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("rep")), "jaccard-reps")

    order = (
        first.where("count IS NOT NULL").groupBy("cls").agg(F.sum("count").alias("count"))
        .where(F.col("count") >= FREQUENT).orderBy(F.desc("count"), "cls").limit(ORDER_SIZE).toArrow()
    )
    common = order["cls"].to_numpy().view(np.uint64)
    sort = np.argsort(common)
    common, counts = common[sort], order["count"].to_numpy()[sort]
    del order
    pa.default_memory_pool().release_unused()

    posts = rows.select("text").mapInArrow(_postings(common, counts), "tok long, cls long, head long, pos int, known boolean")
    shared = saved(_shared(posts), "jaccard-postings")

    spread = shared.select(
        "tok", "cls", "m", F.shiftright("head", 20).cast("int").alias("n"), (F.shiftright("head", 8) % 4096).cast("int").alias("share"),
        (F.col("head") % 256).cast("int").alias("l"), "pos",
    )
    # Sizes of linked sets differ by a factor of 4/3 at most: two neighbouring size bands.
    spread = spread.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.34))).cast("int"))
    spread = spread.withColumn("at", F.explode(F.array(F.col("band"), F.col("band") + 1)))

    hub = F.max(F.struct("share", *_SIDE)).alias("hub")
    hubs = spread.groupBy("tok", "at").agg(hub, F.min("cls").alias("low"), F.max("cls").alias("high")).where("low <> high")
    hubs = hubs.select("tok", "at", *[F.col(f"hub.{c}").alias(c + "A") for c in _SIDE])
    star = hubs.join(spread.select("tok", "at", *_side(spread, "B")), ["tok", "at"]).where(f"clsA <> clsB AND {_POSSIBLE}")
    # A class tries the hub with which it shares most.
    star_pairs = saved(_counted(star).groupBy("b").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", "b"), "jaccard-hub-pairs")
    texts = _texts(rows, star_pairs, classes)
    links = saved(_links(star_pairs, texts), "jaccard-hub-links")
    discard(texts)
    label = connected_components(links, "jaccard-hubs").select(F.col("node").alias("cls"), F.col("component").alias("comp"))

    # The rest: classes that meet in a group and aren't known to be connected.
    placed = spread.join(label, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    several = placed.groupBy("tok", "at").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    placed = saved(placed.join(several.select("tok", "at"), ["tok", "at"]), "jaccard-open")
    smaller, larger = (placed.select("tok", "at", F.col("comp").alias("comp" + x), *_side(placed, x)) for x in "AB")
    smaller = smaller.where(f"posA < nA - cast(ceil({2 * NUM} * nA / {NUM + DEN}) AS int) + lA")
    rest = smaller.join(larger, ["tok", "at"]).where(
        f"(nA < nB OR nA = nB AND clsA < clsB) AND compA <> compB AND {_LEVEL} <= least(lA, lB) AND {_POSSIBLE}"
    )
    tried = star_pairs.select("a", "b").union(star_pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    rest_pairs = _counted(rest).select("a", "b")
    rest_pairs = saved(rest_pairs.join(tried, ["a", "b"], "left_anti"), "jaccard-other-pairs")
    texts = _texts(rows, rest_pairs, classes)
    more = saved(_links(rest_pairs, texts), "jaccard-other-links")

    ids = classes.select("cls", "rep")
    every = links.union(more).join(ids.select(F.col("cls").alias("a"), F.col("rep").alias("x")), "a").join(ids.select(F.col("cls").alias("b"), F.col("rep").alias("y")), "b")
    found = connected_components(every.select(F.col("x").alias("a"), F.col("y").alias("b")), "jaccard")
    discard(shared, placed, star_pairs, rest_pairs, texts, links, more)
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("cls", "n", F.coalesce("component", "rep").alias("component_id"))
    out = members.join(named, ["cls", "n"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def _shared(posts: DataFrame) -> DataFrame:
    """Postings of shingles that two classes or more hold.  A shingle in the
    global order is known to be one; the rest have few postings each, so a
    window over a shingle is small whatever the input."""
    from pyspark.sql import Window

    per_tok = Window.partitionBy("tok").orderBy("cls")
    rare = posts.where("NOT known").select(
        "tok", "cls", "head", "pos", F.lag("cls").over(per_tok).alias("p"), F.lead("cls").over(per_tok).alias("q")
    ).where("(p IS NOT NULL AND p <> cls) OR (q IS NOT NULL AND q <> cls)").select("tok", "cls", "head", "pos")
    both = rare.union(posts.where("known").select("tok", "cls", "head", "pos"))
    per_class = Window.partitionBy("cls", "head")  # a class's prefix at most, after copies from other tasks go
    return both.dropDuplicates(["cls", "head", "tok"]).withColumn("m", F.count("*").over(per_class).cast("int"))
