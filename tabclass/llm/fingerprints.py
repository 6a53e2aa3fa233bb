"""Document fingerprints: MinHash over 5-word shingles.

Each of PERMUTATIONS universal hash functions (odd multiplier and offset modulo
2**64) keeps its minimum over the shingles of a whole text; the fingerprint is
the list of minima, and the share of equal minima estimates the Jaccard
similarity of two texts' shingle sets.  ``near_pairs`` and ``near_classes`` join
bands of the signature in Spark and verify the Jaccard similarity of what meets.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabclass.llm.common import discard, hash_filter, maybe_in, pick, saved
from tabclass.llm.components import connected_components
from tabclass.llm.shingles import distinct_by_row, text_chunks, text_shingles

WORDS = 5
PERMUTATIONS = 64
BANDS = 16
SIMILAR = 0.75
#: 64-bit words of a class's shingle parities; they save comparing, never a link.
PARITY_WORDS = 16
#: Members of a bucket with which members of other parts are compared in the second
#: round, and members of a large bucket that one task compares.
HUBS, BLOCK = 2, 1024
#: Documents of one stretch of the id order, and stretches at most.
STRETCH, STRETCHES = 4096, 20_000

_rng = np.random.default_rng(20240601)
_MULTIPLY = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PARITY_STEP = np.uint64(0x9E3779B97F4A7C15)
_ADD = _rng.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
EMPTY = np.full(PERMUTATIONS, 0xFFFFFFFF, dtype=np.uint32)


def signatures(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x permutations (uint32); a text without words has EMPTY."""
    value, row = text_shingles(data, offsets, WORDS)
    n_rows = len(offsets) - 1
    out = np.tile(EMPTY, (n_rows, 1))
    if len(value) == 0:
        return out
    n = np.bincount(row, minlength=n_rows)
    full = np.flatnonzero(n)
    start = (np.cumsum(n) - n)[full]
    for j in range(PERMUTATIONS):
        out[full, j] = np.minimum.reduceat((value * _MULTIPLY[j] + _ADD[j]) >> np.uint64(32), start).astype(np.uint32)
    return out


def signature(text: Column) -> Column:
    """The signature of a text column as binary; null counts as empty."""

    @F.arrow_udf("binary")
    def sign(column: pa.Array) -> pa.Array:
        return pa.array([r.tobytes() for _, d, o in text_chunks(column) for r in signatures(d, o)], pa.binary())

    return sign(text)


def likeness(a: Column, b: Column) -> Column:
    """Share of equal minima of two signatures."""

    @F.arrow_udf("double")
    def share(x: pa.Array, y: pa.Array) -> pa.Array:
        left, right = (np.frombuffer(b"".join(v.to_pylist()), dtype=np.uint32).reshape(-1, PERMUTATIONS) for v in (x, y))
        return pa.array((left == right).mean(axis=1) if len(left) else np.zeros(0))

    return share(a, b)


def with_next(rows: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """``rows(doc_id, text, sig)`` with ``next_text, next_sig`` of the document
    with the next id, the last one's being the first.  Ties of an id are
    ordered by text; a row without id has no next (null).  ``marks(doc_id, mark)``,
    one row an id at most, travel with the texts: column ``mark``, null without one.

    Ids are cut into stretches at quantiles, and each stretch also gets the first
    document of the one after it, so every stretch is one independent task.  This
    is the one shuffle of whole texts: marks come along, so no join follows it.
    """
    n = min(STRETCHES, max(1, rows.count() // STRETCH))
    edges = np.array(rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10 * n + 1000)).first()[0] or [], dtype=np.int64)
    edges = np.unique(edges)

    @F.arrow_udf("int")
    def stretch(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right").astype(np.int32))

    if marks is None:
        marks = rows.sparkSession.createDataFrame([], "doc_id long, mark long")
    no_mark = F.lit(None).cast(marks.schema["mark"].dataType)
    nothing = [F.lit(None).cast("string").alias("next_text"), F.lit(None).cast("binary").alias("next_sig"), no_mark.alias("mark")]
    rest = rows.where("doc_id IS NULL").select("doc_id", "text", "sig", *nothing)
    known = rows.where("doc_id IS NOT NULL").withColumn("at", stretch("doc_id"))
    firsts = known.groupBy("at").agg(F.min("doc_id").alias("doc_id")).orderBy("at").collect()
    if not firsts:
        return rest
    goes_to = [(r["doc_id"], firsts[i - 1]["at"]) for i, r in enumerate(firsts)]  # the first of all goes to the last
    copies = rows.sparkSession.createDataFrame(goes_to, "doc_id long, at int")  # one row for each stretch
    heads = rows.join(F.broadcast(copies), "doc_id").groupBy("doc_id", "at").agg(F.min(F.struct("text", "sig")).alias("x"))
    heads = heads.select("doc_id", "x.text", "x.sig", "at")
    marks = marks.select("doc_id", "mark", stretch("doc_id").alias("at"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("binary").alias("sig"), F.lit(False).alias("head"))
    both = known.withColumn("head", F.lit(False)).unionByName(heads.withColumn("head", F.lit(True))).withColumn("mark", no_mark).unionByName(marks)
    # A mark has no text, so it comes just before its document and is no one's next.
    order = Window.partitionBy("at").orderBy("head", "doc_id", "text")
    so_far = F.last(F.when(F.col("text").isNull(), F.struct("doc_id", "mark")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    following = [F.expr(f"lead({c}) IGNORE NULLS OVER (PARTITION BY at ORDER BY head, doc_id, text)").alias(f"next_{c}") for c in ("text", "sig")]
    out = both.select("*", *following, so_far.alias("last_mark")).where("text IS NOT NULL AND NOT head")
    mark = F.when(F.col("last_mark.doc_id") == F.col("doc_id"), F.col("last_mark.mark"))
    return out.select("doc_id", "text", "sig", "next_text", "next_sig", mark.alias("mark")).unionByName(rest)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: DataFrame | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) of every row of ``docs``, and near_class of its id
    if ``classes`` (from ``near_classes``) are given; an id without class has its own.

    The edited text is the text with its last floor(n_chars/2) code points
    replaced by the first as many, or all, of the next document.  Null texts
    count as empty; two texts without words are alike (1).  A row without id has
    no next document: nothing replaces the end, and near_next is 0.
    """
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("sig", signature(F.col("text")))
    linked = with_next(rows, None if classes is None else classes.select("doc_id", F.col("near_class").alias("mark")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    linked = linked.select("doc_id", n.cast("long").alias("n_chars"), "sig", "next_sig", "mark", edited.alias("edited"))
    linked = linked.select("doc_id", "n_chars", "sig", "next_sig", "mark", F.sha2(F.col("edited"), 256).alias("edited_sha256"), signature(F.col("edited")).alias("esig"))
    none = F.lit(bytes(4 * PERMUTATIONS))
    found = linked.select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("sig")).alias("fingerprint"), F.lower(F.hex("esig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("esig")).alias("near_edited"),
        F.when(F.col("next_sig").isNull(), 0.0).otherwise(likeness(F.col("sig"), F.coalesce("next_sig", none))).alias("near_next"),
        F.coalesce("mark", "doc_id").alias("near_class"),
    )
    return found.drop("near_class") if classes is None else found


def parities(value: np.ndarray, row: np.ndarray, n_rows: int) -> np.ndarray:
    """Rows x PARITY_WORDS (int64): bit i is the parity of the number of a row's
    distinct shingles that hash to i.

    A shingle that one of two sets has and the other hasn't flips one bit, so two
    sets differ by at least as many shingles as their parities differ in bits.
    """
    bits = PARITY_WORDS * 64
    at = row.astype(np.int64) * bits + ((value * _PARITY_STEP) >> np.uint64(40)).astype(np.int64) % bits
    odd = (np.bincount(at, minlength=n_rows * bits) & 1).astype(np.uint8).reshape(n_rows, bits)
    return np.packbits(odd, axis=1).view(np.int64)


def _may_link(m: str, n: str, x: str, y: str, similar: float) -> Column:
    """Whether classes of ``m`` and ``n`` shingles with parities ``x`` and ``y`` can be
    ``similar``: sets of that Jaccard similarity J differ by at most
    (1 - J) / (1 + J) of the sum of their sizes.  No similar pair is lost."""
    differ = [F.bit_count(F.col(f"{x}.p{i}").bitwiseXOR(F.col(f"{y}.p{i}"))) for i in range(PARITY_WORDS)]
    sizes = F.least(m, n) / F.greatest(m, n) >= similar
    return sizes & (sum(differ[1:], differ[0]) <= (F.col(m) + F.col(n)) * ((1 - similar) / (1 + similar)) + 1e-6)


def _classes(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, h) of the rows with an id and with words, and (h, rep, sig,
    size, odd) of each of their texts, by its hash, with the smallest id, the number
    of distinct shingles and their parities."""
    rows = pick(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id IS NOT NULL")
    rows = rows.where(F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))).withColumn("h", F.xxhash64("text"))
    fields = [f"p{i}" for i in range(PARITY_WORDS)]

    @F.arrow_udf(f"struct<sig: binary, size: int, odd: struct<{', '.join(f'{f}: bigint' for f in fields)}>>")
    def measure(column: pa.Array) -> pa.Array:
        sigs, sizes, odd = [], [], [np.zeros((0, PARITY_WORDS), np.int64)]
        for _, data, offsets in text_chunks(column):
            sigs += [r.tobytes() for r in signatures(data, offsets)]
            value, row = distinct_by_row(*text_shingles(data, offsets, WORDS))
            sizes.append(np.bincount(row, minlength=len(offsets) - 1))
            odd.append(parities(value, row, len(offsets) - 1))
        words = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(w)) for w in np.concatenate(odd).T], fields)
        return pa.StructArray.from_arrays([pa.array(sigs, pa.binary()), pa.array(np.concatenate([*sizes, []]).astype(np.int32)), words], ["sig", "size", "odd"])

    signed = rows.select("doc_id", "h", measure("text").alias("m"))
    signed = signed.groupBy("h").agg(F.min("doc_id").alias("rep"), F.min("m").alias("m"))
    return rows, saved(signed.select("h", "rep", "m.sig", "m.size", "m.odd"), "near-classes")


def _possible(pairs: DataFrame, classes: DataFrame, similar: float) -> DataFrame:
    """Those ``pairs(x, y)`` whose sizes and parities allow them to be ``similar``."""
    known = classes.select(F.col("h").alias("x"), F.col("size").alias("m"), F.col("odd").alias("xo"))
    both = pairs.join(known, "x").join(known.toDF("y", "n", "yo"), "y")
    return both.where(_may_link("m", "n", "xo", "yo", similar)).select("x", "y")


def _similar(pairs: DataFrame, rows: DataFrame, classes: DataFrame, similar: float) -> DataFrame:
    """(x, y, jaccard) of those ``pairs(x, y)`` of text hashes whose shingle sets
    are ``similar``.

    Of each text only the row with the smallest id is moved, and nearly none of a text
    in no pair: a fixed-size filter is asked before the exact join.
    """
    chosen = pairs.select(F.explode(F.array("x", "y")).alias("h")).distinct()
    chosen = saved(chosen.join(classes.select("h", F.col("rep").alias("doc_id")), "h"), "near-chosen")
    near = rows.where(maybe_in(hash_filter(chosen.select(F.xxhash64("doc_id"))), F.col("doc_id")))
    texts = saved(near.join(chosen, ["h", "doc_id"], "left_semi").groupBy("h").agg(F.min("text").alias("text")), "near-texts")
    both = pairs.join(texts.select(F.col("h").alias("x"), F.col("text").alias("xt")), "x").join(texts.select(F.col("h").alias("y"), F.col("text").alias("yt")), "y")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[np.ndarray]] = [[], []]
            for side in (0, 1):
                for _, data, offsets in text_chunks(batch.column(2 + side)):
                    value, row = distinct_by_row(*text_shingles(data, offsets, WORDS))
                    found[side] += np.split(value, np.searchsorted(row, np.arange(1, len(offsets) - 1)))
            same = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(*found)], dtype=float)
            jaccard = same / np.maximum(1, np.array([len(x) + len(y) for x, y in zip(*found)]) - same)
            good = pa.array(jaccard >= similar)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(jaccard)], names=["x", "y", "jaccard"]).filter(good)

    out = saved(both.select("x", "y", "xt", "yt").mapInArrow(verify, "x long, y long, jaccard double"), "near-links")
    discard(texts, chosen)
    return out


def _parted(posted: DataFrame, links: DataFrame) -> DataFrame:
    """(band, key, h, part) of the members of buckets that ``links(x, y)`` leave in
    several parts."""
    parts = connected_components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), "near-parts").withColumnRenamed("node", "h")
    member = posted.join(parts, "h", "left").select("band", "key", "h", F.coalesce("component", "h").alias("part"))
    split = member.groupBy("band", "key").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low <> high")
    return saved(member.join(split.select("band", "key"), ["band", "key"], "left_semi"), "near-members")


def _links(classes: DataFrame, rows: DataFrame, similar: float) -> tuple[DataFrame, list[DataFrame]]:
    """(x, y, jaccard) of verified pairs of text hashes, with the same connected
    components as all pairs that agree in a whole band and are ``similar``; and
    the written tables that hold them.

    Every bucket of a band is first a star around its hubs, so a group of n
    near-copies gives about 2 n pairs a band and not n squared.  Members that this
    leaves in different parts are then compared with HUBS other members of each
    bucket, which differ from band to band; and those that are still apart with all
    members of other parts whose sizes and parities allow a link.
    """
    width = 4 * PERMUTATIONS // BANDS
    bands = F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(F.substring("sig", i * width + 1, width)).alias("key")) for i in range(BANDS)])
    posted = classes.select("h", "rep", F.explode(bands).alias("b")).select("h", "rep", "b.band", "b.key")
    hubs = posted.groupBy("band", "key").agg(F.array(F.min(F.struct("rep", "h"))["h"], F.min("h")).alias("hubs"), F.count("*").alias("n")).where("n > 1").drop("n")
    posted = saved(posted.join(hubs, ["band", "key"]), "near-buckets")
    star = posted.select("h", F.explode("hubs").alias("hub")).where("h <> hub")
    pair = [F.least("h", "hub").alias("x"), F.greatest("h", "hub").alias("y")]
    compared = saved(_possible(star.select(*pair).distinct(), classes, similar), "near-candidates")
    made = [_similar(compared, rows, classes, similar)]
    member = _parted(posted, made[0])
    discard(posted)
    read = [compared, member]

    place = [F.xxhash64("h", "band", F.lit(i)) for i in range(HUBS)]
    others = member.groupBy("band", "key").agg(F.array(*[F.min(F.struct(p.alias("order"), F.col("h").alias("hub"), F.col("part").alias("p"))) for p in place]).alias("hubs"))
    star = member.join(others, ["band", "key"]).select("h", "part", F.explode(F.array_distinct("hubs")).alias("o")).select("h", "part", "o.hub", "o.p").where("part <> p")
    again = saved(_possible(star.select(*pair).distinct().join(compared, ["x", "y"], "left_anti"), classes, similar), "near-candidates")
    read.append(again)
    if not again.isEmpty():
        made.append(_similar(again, rows, classes, similar))
        if not made[1].isEmpty():
            member = _parted(member.select("band", "key", "h"), made[0].unionByName(made[1]))
            read.append(member)

    rest = saved(_apart(member, classes, similar).join(compared.union(again), ["x", "y"], "left_anti"), "near-candidates")
    if not rest.isEmpty():
        made.append(_similar(rest, rows, classes, similar))
    discard(*read, rest)
    return reduce(DataFrame.unionByName, made), made


def _apart(member: DataFrame, classes: DataFrame, similar: float) -> DataFrame:
    """(x, y) of ``member(band, key, h, part)`` that share a bucket, are of different
    parts and may be ``similar``.

    Only the members outside a bucket's largest part look for partners.  A large
    bucket is dealt out in blocks of about BLOCK members, which they all visit; what
    the join makes is only the pairs that sizes and parities allow.
    """
    sizes = member.groupBy("band", "key", "part").agg(F.count("*").alias("n"))
    largest = sizes.groupBy("band", "key").agg(F.max(F.struct("n", "part"))["part"].alias("main"), F.sum("n").alias("n"))
    largest = largest.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    known = member.join(classes.select("h", "size", "odd"), "h").join(largest.select("band", "key", "main", "blocks"), ["band", "key"])
    every = known.select("band", "key", F.pmod(F.xxhash64("h"), F.col("blocks")).cast("int").alias("block"), F.col("h").alias("y"), F.col("part").alias("q"), F.col("size").alias("n"), F.col("odd").alias("yo"), (F.col("part") != F.col("main")).alias("minor"))
    small = known.where("part <> main").select("band", "key", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), F.col("h").alias("x"), F.col("part").alias("p"), F.col("size").alias("m"), F.col("odd").alias("xo"))
    found = small.join(every, ["band", "key", "block"]).where((F.expr("p <> q AND (NOT minor OR x < y)")) & _may_link("m", "n", "xo", "yo", similar))
    return found.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()


def near_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(a, b, jaccard): pairs of documents whose signatures agree in a whole band
    and whose shingle sets really are ``similar``; not all of them, but enough to
    connect all that such pairs connect.

    Equal texts are joined once, by their smallest id.  Null ids and texts without
    words pair with nothing.
    """
    rows, classes = _classes(docs, id_col, text_col)
    links, _ = _links(classes, rows, similar)
    rep = classes.select("h", "rep")
    found = links.join(rep.toDF("x", "i"), "x").join(rep.toDF("y", "j"), "y")
    return found.select(F.least("i", "j").alias("a"), F.greatest("i", "j").alias("b"), "jaccard").distinct()


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: float = SIMILAR) -> DataFrame:
    """(doc_id, near_class) of every document id: the smallest id that near
    pairs and equal texts connect it with, itself if there is none.  An id with
    several texts has the smallest of their classes."""
    rows, classes = _classes(docs, id_col, text_col)
    links, made = _links(classes, rows, similar)
    parts = connected_components(links.select(F.col("x").alias("a"), F.col("y").alias("b")), "near-classes").withColumnRenamed("node", "h")
    member = classes.select("h", "rep").join(parts, "h", "left").select("h", "rep", F.coalesce("component", "h").alias("part"))
    least = member.groupBy("part").agg(F.min("rep").alias("near_class"))
    named = member.join(least, "part").select("h", "near_class")
    found = rows.select("doc_id", "h").distinct().join(named, "h", "left").groupBy("doc_id").agg(F.min("near_class").alias("near_class"))
    out = saved(found, "near-found")
    discard(classes, *made)
    return out
