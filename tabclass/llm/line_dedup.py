"""Repeated runs of lines, found by winnowing over line hashes.

A *window* starts at a line with words and takes as many consecutive lines as
it needs for ``min_words`` words: one long paragraph, or many short lines.
Each window selects the smallest hash of its lines as its fingerprint.  Equal
windows select equal lines, so every run of that size that two places share
has a common fingerprint, guaranteed, though few lines are ever selected.

1. Selected lines whose hash is selected at one place only rule out all
   windows they stand for: on ordinary text, nearly all.
2. The other windows are joined on their whole content and matched with their
   first occurrence (smallest id, then line).  Places that share a fingerprint
   but not the lines around it fall apart here, so no pairs are enumerated.
3. The lines of later windows are deleted; first occurrences stay.

So a line goes exactly if it lies in a window that occurred at an earlier place.
That leaves the end of a run, after its last full window.  With ``extend``, the
windows that end at a line and reach back for ``min_words`` words are matched
as well.  In a repeated run of that size every line lies in a window of one of
the two kinds inside the run, so a line then goes exactly if it lies in a run of
lines, from one with words to one with words and ``min_words`` in all, that
occurred at any earlier place.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabclass.llm.common import discard, parted, saved
from tabclass.llm.shingles import _inverse, _powers, mix64, text_chunks, words

#: Words that a repeated run has at least.
MIN_WORDS = 50

_STEP = 0xD6E8FEB86659FD93


def line_windows(data: np.ndarray, offsets: np.ndarray, min_words: int, extend: bool = False) -> tuple[np.ndarray, ...]:
    """Windows of a chunk of rows: row, first and last line within the row,
    hash of the content, and the fingerprint with its line.  ``extend`` adds the
    windows that reach back from their last line."""
    n_rows = len(offsets) - 1
    none = np.zeros(0, np.int64)
    breaks = np.flatnonzero(data == 10)
    row_of_break = np.searchsorted(offsets, breaks, side="right") - 1
    start = np.concatenate([offsets[:-1], breaks + 1])
    row = np.concatenate([np.arange(n_rows), row_of_break])
    order = np.lexsort((start, row))
    start, row = start[order], row[order]
    end = np.concatenate([start[1:] - 1, offsets[-1:]]) if len(start) else none
    last_of_row = np.concatenate([row[1:] != row[:-1], [True]]) if len(row) else np.zeros(0, bool)
    end = np.where(last_of_row, offsets[row + 1], end)

    up, down = _powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    line = mix64((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))

    word_start, _, _ = words(data, offsets)
    count = np.searchsorted(word_start, end) - np.searchsorted(word_start, start)
    cum = np.concatenate([[0], np.cumsum(count)])
    first = np.flatnonzero(count > 0)
    last = np.searchsorted(cum, cum[first] + min_words) - 1
    row_end = np.searchsorted(row, row[first], side="right")
    good = last < row_end
    first, last = first[good], last[good]
    if extend:
        tail = np.flatnonzero(count > 0)
        head = np.searchsorted(cum, cum[tail + 1] - min_words, side="right") - 1
        good = head >= np.searchsorted(row, row[tail])
        both = np.unique(np.concatenate([first * len(line) + last, head[good] * len(line) + tail[good]]))
        first, last = both // max(1, len(line)), both % max(1, len(line))
    if len(first) == 0:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none

    powers = np.full(len(line) + 1, _STEP, dtype=np.uint64)
    inverse = np.full(len(line) + 1, _inverse(_STEP), dtype=np.uint64)
    powers[0] = inverse[0] = 1
    powers, inverse = np.cumprod(powers), np.cumprod(inverse)
    sums = np.zeros(len(line) + 1, dtype=np.uint64)
    np.cumsum(line * powers[:-1], out=sums[1:])
    whole = mix64((sums[last + 1] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))

    edges = np.empty(2 * len(first), dtype=np.int64)
    edges[0::2], edges[1::2] = first, last + 1
    padded = np.append(line, np.uint64(0xFFFFFFFFFFFFFFFF))
    print_ = np.minimum.reduceat(padded, edges)[0::2]
    # the line that was selected: the last of the window with that hash
    span = last - first + 1
    flat = np.repeat(first, span) + np.arange(span.sum()) - np.repeat(np.cumsum(span) - span, span)
    hit = np.where(line[flat] == np.repeat(print_, span), flat, -1)
    chosen = np.maximum.reduceat(hit, np.cumsum(span) - span)
    base = np.searchsorted(row, row[first])
    return row[first], first - base, last - base, whole, print_, chosen - base


def _windows(min_words: int, extend: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, offsets in text_chunks(batch.column(2)):
                row, first, last, whole, mark, chosen = line_windows(data, offsets, min_words, extend)
                take = pa.array(row + at)
                yield pa.record_batch(
                    [batch.column(0).take(take), batch.column(1).take(take), pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32)),
                     pa.array(whole.view(np.int64)), pa.array(mark.view(np.int64)), pa.array(chosen.astype(np.int32))],
                    names=["id", "key", "first", "last", "whole", "mark", "chosen"],
                )

    return run


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, extend: bool = False) -> DataFrame:
    """``docs`` with later repeated runs cut out of ``text_col``, and the new
    columns ``n_lines`` and ``n_removed`` (long).

    ``extend`` also cuts the ends of repeated runs, after their last window of
    ``min_words``; without it, only whole windows go, as the query's SQL says.
    Lines are split at ``\\n``; the kept ones are joined again, so a text without
    repeats comes back unchanged and one that only repeats comes back empty.  A
    null text stays null with 0 lines; an empty one stays empty with 1 line.
    Places are ordered by id (null last), then by a hash of the text.  Rows with
    the same id and the same text are one place and come back alike.  Input
    columns named ``n_lines`` or ``n_removed`` are replaced; others are kept.
    """
    docs = docs.drop("n_lines", "n_removed")
    id_, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    key = F.xxhash64(id_.cast("string"), text)
    rows = docs.select(id_.cast("long").alias("id"), key.alias("key"), text.alias("text")).where("text IS NOT NULL")
    schema = "id long, key long, first int, last int, whole long, mark long, chosen int"
    windows = saved(rows.mapInArrow(_windows(min_words, extend), schema), "line-windows")

    places = windows.groupBy("mark", "key", "chosen").agg(F.lit(1).alias("one"))
    repeated = places.groupBy("mark").agg(F.count("*").alias("n")).where("n > 1").select("mark")
    open_ = windows.join(repeated, "mark", "left_semi").select("id", "key", "first", "last", "whole")
    open_ = saved(open_.distinct(), "line-open-windows")
    place = F.struct(F.col("id").isNull().alias("null"), "id", "key", "first")
    origin = open_.groupBy("whole").agg(F.min(place).alias("origin"), F.count("*").alias("n")).where("n > 1").select("whole", "origin")
    later = open_.join(origin, "whole").where(place != F.col("origin")).select("key", "first", "last")
    lines = later.select("key", F.explode(F.sequence("first", "last")).alias("line")).distinct()
    gone = saved(lines.groupBy("key").agg(F.collect_set("line").alias("_gone")), "line-gone")  # a document's own lines at most
    discard(windows, open_)

    def n_lines(t: Column) -> Column:
        return F.when(t.isNull(), 0).otherwise(F.length(t) - F.length(F.replace(t, F.lit("\n"))) + 1).cast("long").alias("n_lines")

    clear, rest = parted(docs, F.when(text.isNotNull(), key), gone.select("key"))
    clear = clear.select("*", n_lines(text), F.lit(0).cast("long").alias("n_removed"))
    # Whole rows travel as one struct, so the input's names can't clash with the join's.
    rest = rest.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), key.alias("key")).join(gone, "key", "left")
    field = {c: F.col("row").getField(c) for c in docs.columns}
    parts = F.split(field[text_col], "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("_gone"))
    field_text = F.when(F.col("_gone").isNull(), field[text_col]).otherwise(F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    columns = [(field_text if c == text_col else field[c]).alias(c) for c in docs.columns]
    return clear.unionByName(rest.select(*columns, n_lines(field[text_col]), F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed")))
