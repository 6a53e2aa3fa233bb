"""Benchmark passages in documents, also with other numbers, names or units.

Words lose their outer punctuation and case; numbers become a NUM placeholder,
capitalised words inside a sentence a NAME, units of measure after a number a
UNIT.  Windows of ``window`` words of every document are hash-joined with those
of the benchmark items, by two routes:

- template words.  Windows on the same diagonal (document position minus item
  position) that touch or overlap form one run.  Its slots must be consistent: a
  value of the item always stands for the same value of the document, as in a
  question asked again with other parameters; else the run doesn't count.
- literal words, whatever they are: a verbatim window always counts.

An item shorter than a window is one window, looked for at every position of the
documents.  A document leaks an item if the windows that count on one diagonal
cover ``min_run`` words of it, or the whole item if that is shorter.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabclass.llm.common import hash_filter, in_filter, pick, saved
from tabclass.llm.shingles import STEP, _LOWER, _SPACE, mix64, text_chunks, word_hashes, words

#: Template words of a window, and of a passage that counts.
WINDOW = 8
MIN_RUN = 13
#: Literal words that a template window has at least; with fewer it says nothing.
MIN_LITERALS = 4

# Units of measure and currency words, lower case.
UNITS = (
    "mm cm m km in inch inches ft feet foot yd yards mile miles mg g kg kgs gram grams ton tons lb lbs oz ml cl l liter "
    "liters litre litres s sec secs second seconds min mins minute minutes h hr hrs hour hours day days week weeks month "
    "months year years percent usd eur gbp dollar dollars euro euros cent cents pound pounds kmh mph w kw kwh v hz khz mhz ghz"
).split()

NUM, NAME, UNIT = (np.uint64(v) for v in (0x4E554D, 0x4E414D45, 0x554E4954))

_CLASS = np.zeros(256, dtype=np.uint8)  # 0 other, 1 lower or beyond ASCII, 2 upper, 3 digit
_CLASS[97:123] = 1
_CLASS[128:] = 1
_CLASS[65:91] = 2
_CLASS[48:58] = 3
_STOP = np.zeros(256, dtype=bool)
_STOP[[ord(c) for c in ".!?:;"]] = True


def _one(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    return word_hashes(data, np.array([0]), np.array([len(data)]))[0]


#: Keeps the hashes of literal windows apart from those of template windows.
_LITERAL = 1 << 32
_UNIT_HASHES = np.sort(np.array([_one(u) for u in UNITS], dtype=np.uint64))


def template(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(template hash, value hash, row) of every word with a letter or digit.
    For literal words both hashes are the same."""
    start, end, row = words(data, offsets)
    if len(start) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), row
    kind = _CLASS[data]
    solid = np.append(np.flatnonzero(kind > 0), len(data))
    first = solid[np.searchsorted(solid, start)]  # outer punctuation goes
    before = np.searchsorted(solid, end) - 1
    last = np.where(before >= 0, solid[np.maximum(before, 0)], -1)
    keep = first < end
    start, end, row, first, last = start[keep], end[keep], row[keep], first[keep], last[keep]
    if len(start) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), row
    # a word opens a sentence after a stop, at a line's start, and at a row's start
    gap_break = np.concatenate([[0], np.cumsum(data == 10)])
    opens = np.ones(len(start), dtype=bool)
    opens[1:] = (row[1:] != row[:-1]) | _STOP[data[end[:-1] - 1]] | (gap_break[start[1:]] > gap_break[end[:-1]])
    upper = np.concatenate([[0], np.cumsum(kind == 2)])
    letters = np.concatenate([[0], np.cumsum((kind == 1) | (kind == 2))])
    digits = np.concatenate([[0], np.cumsum(kind == 3)])
    stop = last + 1
    n_upper, n_letters, n_digits = (x[stop] - x[first] for x in (upper, letters, digits))
    value = word_hashes(_LOWER[data], first, stop)
    is_num = (n_digits > 0) & (n_letters == 0)
    is_name = (kind[first] == 2) & (n_upper == 1) & (n_letters > 1) & ~opens & ~is_num
    after_num = np.zeros(len(start), dtype=bool)
    after_num[1:] = is_num[:-1] & (row[1:] == row[:-1])
    at = np.minimum(np.searchsorted(_UNIT_HASHES, value), len(_UNIT_HASHES) - 1)
    is_unit = after_num & (_UNIT_HASHES[at] == value)
    code = np.where(is_num, NUM, np.where(is_unit, UNIT, np.where(is_name, NAME, value)))
    return code, value, row


def word_windows(code: np.ndarray, value: np.ndarray, row: np.ndarray, begin: np.ndarray, size: int, literal: bool) -> tuple[np.ndarray, ...]:
    """(row, position, hash, first word) of the windows of ``size`` words within a
    row, of literal or of template words.  Template windows with too few literal
    words are left out."""
    n = len(code)
    if n < size:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty.astype(np.uint64), empty
    word = value if literal else code
    h = np.zeros(n - size + 1, dtype=np.uint64)
    for j in range(size):
        h = h * STEP + word[j : n - size + 1 + j]
    good = row[: n - size + 1] == row[size - 1 :]
    if not literal:
        same = np.concatenate([[0], np.cumsum(code == value)])
        good &= same[size:] - same[:-size] >= min(MIN_LITERALS, size)
    at = np.flatnonzero(good)
    return row[at], at - begin[row[at]], mix64(h[at] + np.uint64(size + (_LITERAL if literal else 0))), at


def _lists(code: np.ndarray, value: np.ndarray, first: np.ndarray, size: int) -> pa.Array:
    """Values of the slots of each window (0 at literal words)."""
    flat = (first[:, None] + np.arange(size)).ravel()
    slots = np.where(code[flat] == value[flat], np.uint64(0), value[flat])
    return pa.ListArray.from_arrays(pa.array((np.arange(len(first) + 1) * size).astype(np.int32)), pa.array(slots.view(np.int64)))


def _emit(window: int, bitmap: np.ndarray | None, short: tuple[int, ...] = ()):
    """Windows of both routes: of items (no bitmap), one window for an item
    shorter than ``window``; of documents, also windows of the ``short`` lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_chunks(batch.column(1)):
                code, value, row = template(data, offsets)
                n_rows = len(offsets) - 1
                count = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
                begin = np.concatenate([[0], np.cumsum(count)])
                sizes = sorted({window, *short}) if bitmap is not None else sorted({window, *count[(count > 0) & (count < window)].tolist()})
                for size in sizes:
                    for literal in (False, True):
                        where, pos, hashes, first = word_windows(code, value, row, begin, size, literal)
                        if bitmap is None and size < window:
                            hit = count[where] == size
                        elif bitmap is not None and len(hashes):
                            hit = in_filter(bitmap, hashes)
                        else:
                            hit = np.ones(len(hashes), dtype=bool)
                        where, pos, hashes, first = where[hit], pos[hit], hashes[hit], first[hit]
                        slots = _lists(code, value, first, 0 if literal else size)
                        yield pa.record_batch(
                            [batch.column(0).take(pa.array(where + at)), pa.array(count[where]), pa.array(pos), pa.array(hashes.view(np.int64)), slots,
                             pa.array(np.full(len(where), literal))],
                            names=["id", "n", "pos", "hash", "slots", "literal"],
                        )

    return run


_SCHEMA = "id long, n long, pos long, hash long, slots array<long>, literal boolean"


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, min_run: int = MIN_RUN,
) -> DataFrame:
    """(doc_id, item_id, n_words): one row for each document and item that leaks
    into it, with the words that count of the best aligned passage.

    Null and empty texts leak nothing.  Rows that repeat a document id count as
    one document, likewise items; ids that are null are left out.  Other columns
    are ignored.  An empty benchmark gives an empty result.
    """
    items = pick(benchmark, id=item_id, text=item_text).select(F.col("id").cast("long").alias("id"), "text").where("id IS NOT NULL")
    items = saved(items.mapInArrow(_emit(window, None), _SCHEMA), "leak-items")
    bitmap = hash_filter(items.select("hash"))
    short = tuple(r["n"] for r in items.where(F.col("n") < window).select("n").distinct().collect())  # fewer than window
    rows = pick(docs, id=id_col, text=text_col).select(F.col("id").cast("long").alias("id"), "text").where("id IS NOT NULL")
    hits = rows.mapInArrow(_emit(window, bitmap, short), _SCHEMA)
    hits = hits.select(F.col("id").alias("doc_id"), F.col("pos").alias("dpos"), "hash", "literal", F.col("slots").alias("dslots"))
    items = items.select(F.col("id").alias("item_id"), "n", F.col("pos").alias("ipos"), "hash", "literal", F.col("slots").alias("islots"))
    both = hits.join(items, ["hash", "literal"]).withColumn("diagonal", F.col("dpos") - F.col("ipos"))
    # Runs: windows of an item that touch or overlap, at most the item's length in a group.
    along = Window.partitionBy("doc_id", "item_id", "diagonal", "literal").orderBy("ipos")
    gap = F.when(F.col("ipos") > F.lag("ipos").over(along) + window, 1).otherwise(0)
    both = saved(both.withColumn("gap", gap).withColumn("run", F.sum("gap").over(along)).drop("gap"), "leak-hits")

    passage = ["doc_id", "item_id", "diagonal"]
    run = [*passage, "run"]
    templates = both.where("NOT literal")
    slots = templates.select(*run, F.explode(F.arrays_zip("islots", "dslots")).alias("s")).where("s.islots <> 0")
    bound = slots.groupBy(*run, "s.islots").agg(F.min("s.dslots").alias("low"), F.max("s.dslots").alias("high"))
    broken = bound.where("low <> high").select(*run).distinct()
    sound = templates.join(broken, run, "left_anti").select(*passage, "n", "ipos").unionByName(both.where("literal").select(*passage, "n", "ipos"))

    # Words of the item that the windows cover.
    covered = sound.select(*passage, "n", F.explode(F.sequence(F.col("ipos"), F.col("ipos") + F.least(F.lit(window), F.col("n")) - 1)).alias("at")).distinct()
    size = covered.groupBy(*passage, "n").agg(F.count("*").alias("n_words"))
    long_enough = size.where(F.col("n_words") >= F.least(F.lit(min_run), F.col("n")))
    return long_enough.groupBy("doc_id", "item_id").agg(F.max("n_words").alias("n_words"))
