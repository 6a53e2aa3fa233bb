"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

``build_index`` scans the documents once for the two corpus figures (documents with
a term, all terms) and once more to write segments: one row holds the postings of
about SEGMENT_BYTES of whole texts, as byte strings.  A term's list is cut into
blocks of BLOCK postings; a block has its first document, its greatest impact and,
compressed to the bytes they need, the gaps and frequencies.  Nothing is shuffled,
and a lost executor costs the segments it was building.

``search`` looks the terms' document frequencies up in the segments' dictionaries,
then lets every task run all queries over its segments, one after the other.  Of
each query a task keeps a heap of its best k, whose least score is the bar:

* the lists, by ascending bound of what a list can add to a score, are cut where
  the bounds' sum reaches the bar; documents that occur only below the cut can't
  pass it, so only the lists above it are read (the essential ones);
* candidates then meet the other lists, the highest bound first.  A candidate goes
  as soon as its score with all that may follow is below the bar; before a list is
  read, the block maxima at the candidates reject once more, and only blocks in
  which a candidate is left are decompressed.

The tasks' heaps are merged in two steps, so that no task gets the heaps of all
shards.  Scores are integers, so the result doesn't depend on the order of sums;
equal scores rank by ascending doc_id, null ids last.

Terms are runs of 0-9, A-Z, a-z and of all characters beyond ASCII, only A-Z
lower-cased.  With N documents that have a term and L terms in all, a document of n
terms has m = 100 - 25 + 25nN div L; a term of weight w = floor(1000 ln((2N + 2) /
(2df + 1))) and frequency tf adds w * (10^9 tf div (1000 tf + 12 m)).

Edge cases: null and empty texts have no terms and are never found.  Repeated
documents are documents of their own, each ranked.  Repeated query rows (same id
and text) count once; a query without a term, or of terms no document has, gets no
rows.  Empty tables give an empty table.  Other columns are not looked at.
"""
from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabclass.llm.common import discard, pick, saved, small_batches
from tabclass.session import scratch_path

#: Text of a segment; a longer text is a segment by itself.
SEGMENT_BYTES = 4 << 20
SEGMENT_DOCS = 1 << 16
BLOCK = 128
#: Query terms that are broadcast at once; more queries go in several batches.
BATCH_TERMS = 200_000
#: Terms of documents for each search task, about.
TASK_TERMS = 8_000_000
#: Segments in an Arrow batch.
SEGMENT_ROWS = 2
TOP = 20

_TERM = np.zeros(256, dtype=bool)
_TERM[48:58] = _TERM[65:91] = _TERM[97:123] = _TERM[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a string column; nulls have no bytes."""
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of a term, inside a term) for every byte."""
    inside = _TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < len(data)]
    first[cuts] = inside[cuts]
    return first, inside


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """Every term in order, and its row."""
    first, inside = _bounds(data, offsets)
    start = np.flatnonzero(first)
    packed = _LOWER[data[inside]]
    at = np.concatenate([(np.cumsum(inside) - 1)[start], [len(packed)]]).astype(np.int64) if len(start) else np.zeros(1, np.int64)
    found = pa.Array.from_buffers(pa.large_string(), len(start), [None, pa.py_buffer(at.tobytes()), pa.py_buffer(packed.tobytes())])
    return found, np.searchsorted(offsets, start, side="right") - 1


def impacts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 75 + (25 * lengths * n_docs) // max(1, n_terms)


# ------------------------------------------------------------------- segments
_ARRAYS = {
    "lengths": np.int64, "term_at": np.int64, "df": np.int32, "block_first": np.uint16, "block_max": np.int32,
    "block_width": np.uint8,
}
SEGMENT = "doc_ids array<long>, term_bytes binary, data binary, " + ", ".join(f"{c} binary" for c in _ARRAYS)


def encode(ids: pa.Array, column: pa.Array, n_docs: int, n_terms: int) -> dict | None:
    """The segment of these documents; None if they have no term."""
    data, offsets = texts(column)
    found, row = terms(data, offsets)
    if len(row) == 0:
        return None
    count = len(offsets) - 1
    names = found.dictionary_encode()
    key, tf = np.unique(names.indices.to_numpy().astype(np.int64) * count + row, return_counts=True)
    lengths = np.bincount(row, minlength=count).astype(np.int64)
    code, doc = key // count, key % count
    impact = impacts(tf.astype(np.int64), norms(lengths, n_docs, n_terms)[doc])
    df = np.bincount(code, minlength=len(names.dictionary))
    in_list = np.arange(len(code)) - (np.cumsum(df) - df)[code]
    start = np.flatnonzero(in_list % BLOCK == 0)
    size = np.diff(np.append(start, len(code)))
    gap = np.diff(doc, prepend=0)
    gap[start] = 0
    wide_gap = 1 + (np.maximum.reduceat(gap, start) > 255)
    most = np.maximum.reduceat(tf, start)
    wide_tf = np.select([most == 1, most < 1 << 8, most < 1 << 16], [0, 1, 2], 4)
    layout = Layout(size, wide_gap, wide_tf)
    out = np.zeros(layout.total, dtype=np.uint8)
    block = np.repeat(np.arange(len(start)), size)
    j = np.arange(len(code)) - start[block]
    for wide, value, base, skip in ((wide_gap, gap, layout.gaps, 1), (wide_tf, tf, layout.tfs, 0)):
        for k in range(4):
            at = np.flatnonzero((wide[block] > k) & (j >= skip))
            b = block[at]
            out[base[b] + (j[at] - skip) * wide[b] + k] = (value[at] >> (8 * k)) & 255
    # A document's place in the segment is its row; only ids and lengths are kept of it.
    _, term_at, term_bytes = names.dictionary.buffers()
    arrays = {
        "lengths": lengths, "term_at": np.frombuffer(term_at, np.int64)[: len(names.dictionary) + 1], "df": df, "block_first": doc[start],
        "block_max": np.maximum.reduceat(impact, start), "block_width": wide_gap * 8 + wide_tf,
    }
    packed = {c: arrays[c].astype(kind).tobytes() for c, kind in _ARRAYS.items()}
    return {"doc_ids": ids.to_pylist(), "term_bytes": term_bytes.to_pybytes()[: int(arrays["term_at"][-1])], "data": out.tobytes()} | packed


class Layout:
    """Where each block's gaps and frequencies are in the data."""

    def __init__(self, size: np.ndarray, wide_gap: np.ndarray, wide_tf: np.ndarray) -> None:
        long = size.astype(np.int64)
        bytes_of = (long - 1) * wide_gap + long * wide_tf
        self.gaps = np.cumsum(bytes_of) - bytes_of
        self.tfs = self.gaps + (long - 1) * wide_gap
        self.total = int(bytes_of.sum())


def segment_terms(row: dict) -> pa.Array:
    at = row["term_at"]
    return pa.Array.from_buffers(pa.large_string(), len(at) // 8 - 1, [None, pa.py_buffer(at), pa.py_buffer(row["term_bytes"])])


class Segment:
    """A segment as it was read; lists stay compressed until ``read`` is asked for blocks."""

    def __init__(self, row: dict, n_docs: int, n_terms: int) -> None:
        raw = {c: np.frombuffer(row[c], dtype=kind) for c, kind in _ARRAYS.items()}
        self.ids = row["doc_ids"]
        self.m = norms(raw["lengths"], n_docs, n_terms)
        self.first, self.max, width = raw["block_first"].astype(np.int64), raw["block_max"].astype(np.int64), raw["block_width"]
        df = raw["df"].astype(np.int64)
        blocks = -(-df // BLOCK)
        self.list_end = np.cumsum(blocks)
        self.list_start = self.list_end - blocks
        self.size = np.full(len(self.first), BLOCK, dtype=np.int64)
        self.size[self.list_end - 1] = df - (blocks - 1) * BLOCK
        self.list_max = np.maximum.reduceat(self.max, self.list_start)
        self.wide_gap, self.wide_tf = (width >> 3).astype(np.int64), (width & 7).astype(np.int64)
        self.layout = Layout(self.size, self.wide_gap, self.wide_tf)
        self.data = np.concatenate([np.frombuffer(row["data"], dtype=np.uint8), np.zeros(4, np.uint8)])
        self.blocks_read = 0

    def read(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(document, impact, place of its block in ``blocks``) of all postings of these blocks."""
        self.blocks_read += len(blocks)
        size = self.size[blocks]
        end = np.cumsum(size)
        where = np.repeat(np.arange(len(blocks)), size)
        j = np.arange(int(end[-1])) - (end - size)[where]
        wide = self.wide_gap[blocks][where]
        at = self.layout.gaps[blocks][where] + np.maximum(j - 1, 0) * wide
        value = self.data[at].astype(np.int64)
        two = wide == 2
        value[two] += self.data[at[two] + 1].astype(np.int64) << 8
        value[end - size] = 0
        total = np.cumsum(value)
        doc = total - total[end - size][where] + self.first[blocks][where]
        wide = self.wide_tf[blocks][where]
        tf = np.ones(len(j), dtype=np.int64)
        some = np.flatnonzero(wide > 0)
        if len(some):
            wide = wide[some]
            at = self.layout.tfs[blocks][where[some]] + j[some] * wide
            got = self.data[at].astype(np.int64)
            for k in (1, 2, 3):
                more = np.flatnonzero(wide > k)
                got[more] += self.data[at[more] + k].astype(np.int64) << (8 * k)
            tf[some] = got
        return doc, impacts(tf, self.m[doc]), where


@dataclass
class Heap:
    """The best k of a query so far; ``bar`` is the least score that may still enter."""

    k: int
    score: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    doc: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    null: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    @property
    def bar(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def merge(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        score, doc, null = np.append(self.score, score), np.append(self.doc, doc), np.append(self.null, null)
        best = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[best], doc[best], null[best]


def _kth(values: np.ndarray, k: int) -> int:
    return int(np.partition(values, len(values) - k)[len(values) - k])


def search_segment(seg: Segment, lists: np.ndarray, weight: np.ndarray, heap: Heap) -> None:
    """Block-Max MaxScore of one query (its lists in this segment, and what an
    impact of each counts) over one segment, into the heap."""
    bound = weight * seg.list_max[lists]
    order = np.argsort(bound, kind="stable")
    lists, weight, upto = lists[order], weight[order], np.cumsum(bound[order])
    bar = heap.bar
    cut = int(np.searchsorted(upto, bar, side="left"))
    if cut == len(lists):
        return
    score = np.zeros(len(seg.m), dtype=np.int64)
    ranges = [np.arange(seg.list_start[i], seg.list_end[i]) for i in lists[cut:]]
    doc, impact, where = seg.read(np.concatenate(ranges))
    np.add.at(score, doc, impact * np.repeat(weight[cut:], [len(r) for r in ranges])[where])
    left = np.flatnonzero(score)
    for i in range(cut - 1, -1, -1):
        if len(left) >= heap.k:
            bar = max(bar, _kth(score[left], heap.k))
        left = left[score[left] + upto[i] >= bar]
        if len(left) == 0:
            return
        start, end = seg.list_start[lists[i]], seg.list_end[lists[i]]
        block = start + np.searchsorted(seg.first[start:end], left, side="right") - 1
        there = block >= start
        at_most = score[left] + np.where(there, weight[i] * seg.max[np.maximum(block, 0)], 0) + (upto[i - 1] if i else 0)
        keep = at_most >= bar
        left, needed = left[keep], np.unique(block[keep & there])
        if len(needed):
            doc, impact, _ = seg.read(needed)
            score[doc] += weight[i] * impact
    left = left[score[left] >= bar]
    if len(left) > heap.k:
        left = left[score[left] >= _kth(score[left], heap.k)]
    if len(left):
        ids = pa.array(seg.ids, pa.int64()).take(pa.array(left))
        heap.merge(score[left], ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False))


# ---------------------------------------------------------------------- Spark
@dataclass
class Index:
    segments: DataFrame
    n_docs: int
    n_terms: int

    def discard(self) -> None:
        discard(self.segments)


@contextmanager
def _small_rows(spark: SparkSession) -> Iterator[None]:
    """Few segments in a batch, for Parquet's reader and for Arrow."""
    key = "spark.sql.parquet.columnarReaderBatchSize"
    before = spark.conf.get(key)
    spark.conf.set(key, 8 * SEGMENT_ROWS)
    try:
        with small_batches(spark, SEGMENT_ROWS):
            yield
    finally:
        spark.conf.set(key, before)


def corpus_figures(docs: DataFrame) -> tuple[int, int]:
    """(documents with a term, terms of all documents) of ``docs(text)``."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = np.zeros(2, dtype=np.int64)
            for i in range(0, batch.num_rows, 64):
                data, offsets = texts(batch.column("text").slice(i, 64))
                per = np.bincount(np.searchsorted(offsets, np.flatnonzero(_bounds(data, offsets)[0]), side="right") - 1, minlength=1)
                n += [(per > 0).sum(), per.sum()]
            yield pa.RecordBatch.from_arrays([pa.array(n[:1]), pa.array(n[1:])], ["docs", "terms"])

    with small_batches(docs.sparkSession):
        r = docs.select("text").mapInArrow(count, "docs long, terms long").agg(F.sum("docs"), F.sum("terms")).first()
    return int(r[0] or 0), int(r[1] or 0)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Index:
    """The index of all rows of ``docs``, below the shared checkpoint folder."""
    spark = docs.sparkSession
    rows = pick(docs, doc_id=id_col, text=text_col)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n_docs, n_terms = corpus_figures(rows)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_ids", pa.list_(pa.int64())), ("term_bytes", pa.binary()), ("data", pa.binary()), *[(c, pa.binary()) for c in _ARRAYS]])
        held: list[pa.RecordBatch] = []
        size = count = 0

        def flush() -> Iterator[pa.RecordBatch]:
            whole = pa.Table.from_batches(held).sort_by("doc_id")
            held.clear()
            made = encode(whole["doc_id"].combine_chunks(), whole["text"].combine_chunks(), n_docs, n_terms)
            if made is not None:
                yield pa.RecordBatch.from_pylist([made], schema)

        for batch in batches:
            long = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy().astype(np.int64))])
            i = 0
            while i < batch.num_rows:
                fits = int(np.searchsorted(long, long[i] + SEGMENT_BYTES - size, side="right")) - 1
                j = min(max(fits, i + (size == 0)), batch.num_rows, i + SEGMENT_DOCS - count)
                if j > i:
                    held.append(batch.slice(i, j - i))
                    size, count = size + int(long[j] - long[i]), count + j - i
                if j < batch.num_rows or size >= SEGMENT_BYTES or count >= SEGMENT_DOCS:
                    yield from flush()
                    size = count = 0
                i = j
        if held:
            yield from flush()

    path = scratch_path(spark, "search-index")
    with small_batches(spark):
        out = rows.mapInArrow(segments, SEGMENT).write.option("compression", "zstd")
        # A row is a segment of megabytes: look at the size of a row group after every one.
        out.option("parquet.block.size", 16 << 20).option("parquet.page.size.row.check.min", 1).parquet(path)
    table = spark.read.schema(SEGMENT).parquet(path)
    table._scratch = path
    return Index(table, n_docs, n_terms)


def query_terms(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(query, item_id, term, tf) of the distinct queries; ``query`` is a hash of id and text."""
    rows = pick(queries, item_id=id_col, text=text_col).distinct()
    rows = rows.select(F.xxhash64("item_id", "text").alias("query"), "item_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 64):
                part = batch.slice(i, 64)
                found, row = terms(*texts(part.column("text")))
                flat = pa.table([part.column("query").take(pa.array(row)), part.column("item_id").take(pa.array(row)), found.cast(pa.string())], ["query", "item_id", "term"])
                yield from flat.to_batches()

    flat = rows.mapInArrow(split, f"query long, item_id {kind}, term string")
    return flat.groupBy("query", "item_id", "term").agg(F.count("*").alias("tf"))


def search(index: Index, queries: DataFrame, k: int = TOP, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score) of each query's k best documents."""
    spark = queries.sparkSession
    wanted = saved(query_terms(queries, id_col, text_col), "search-queries")
    batches = max(1, -(-wanted.count() // BATCH_TERMS))
    # Fewer, longer tasks keep fewer heaps and meet more of a segment's lists above the bar.
    tasks = max(spark.sparkContext.defaultParallelism, -(-index.n_terms // TASK_TERMS))
    heaps = None
    for b in range(batches):
        part = wanted.where(F.pmod(F.xxhash64("query"), F.lit(batches)) == b) if batches > 1 else wanted
        found = _search_batch(index, part.toArrow().to_pydict(), k, tasks)
        heaps = found if heaps is None else heaps.unionByName(found)
    ids = wanted.select("query", "item_id").distinct()
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    for keys in (["query", "shelf"], ["query"]):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*best))
        heaps = heaps.withColumn("rank", rank).where(F.col("rank") <= k)
    return ids.join(heaps, "query").select("item_id", "rank", "doc_id", "score")


def _search_batch(index: Index, asked: dict, k: int, tasks: int) -> DataFrame:
    """(query, doc_id, score, shelf): the heaps of all tasks for these query terms."""
    names = sorted(set(asked["term"]))
    place = {t: i for i, t in enumerate(names)}
    vocabulary = pa.array(names, pa.large_string())
    n_docs, n_terms, segments = index.n_docs, index.n_terms, index.segments
    spark = segments.sparkSession

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(names), dtype=np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                code = pc.index_in(vocabulary, value_set=segment_terms(row)).fill_null(-1).to_numpy()
                total[code >= 0] += np.frombuffer(row["df"], np.int32)[code[code >= 0]]
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["term", "df"])

    with _small_rows(spark):
        df = segments.select("term_bytes", "term_at", "df").coalesce(tasks).mapInArrow(frequencies, "term long, df long")
        weights = df.groupBy("term").agg(F.sum("df").alias("df")).select(
            "term", F.floor(1000 * F.log((F.lit(2 * n_docs + 2).cast("double")) / (2 * F.col("df") + 1).cast("double"))).cast("long").alias("w")
        ).toArrow()
    weight = np.full(len(names), -1, dtype=np.int64)
    weight[weights["term"].to_numpy()] = weights["w"].to_numpy()
    by_query: dict[int, list[tuple[int, int]]] = {}
    for q, t, tf in zip(asked["query"], asked["term"], asked["tf"]):
        if weight[place[t]] >= 0:
            by_query.setdefault(q, []).append((place[t], tf * int(weight[place[t]])))
    plans = {q: (np.array([x[0] for x in v]), np.array([x[1] for x in v], dtype=np.int64)) for q, v in by_query.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = {q: Heap(k) for q in plans}
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                code = pc.index_in(vocabulary, value_set=segment_terms(row)).fill_null(-1).to_numpy().astype(np.int64)
                seg = Segment(row, n_docs, n_terms)
                for q, (t, w) in plans.items():
                    lists = code[t]
                    there = lists >= 0
                    if there.any():
                        search_segment(seg, lists[there], w[there], heaps[q])
        full = [(q, h) for q, h in heaps.items() if len(h.score)]
        if full:
            column = lambda f: np.concatenate([f(q, h) for q, h in full])
            yield pa.RecordBatch.from_arrays(
                [pa.array(column(lambda q, h: np.full(len(h.score), q))), pa.array(column(lambda q, h: h.doc), mask=column(lambda q, h: h.null)), pa.array(column(lambda q, h: h.score))],
                ["query", "doc_id", "score"],
            )

    shelf = F.pmod(F.spark_partition_id(), F.lit(max(1, round(tasks**0.5))))
    with _small_rows(spark):
        heaps = segments.coalesce(tasks).mapInArrow(run, "query long, doc_id long, score long").withColumn("shelf", shelf)
        return _kept(heaps)


def _kept(heaps: DataFrame) -> DataFrame:
    """Written while the small batches are set."""
    spark = heaps.sparkSession
    path = scratch_path(spark, "search-heaps")
    heaps.write.parquet(path)
    out = spark.read.schema("query long, doc_id long, score long, shelf int").parquet(path)
    out._scratch = path
    return out
