"""Word shingles of whole texts, hashed in vectorised numpy.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lower-cased;
in UTF-8 that is the same as working on code points.  A text is hashed by
prefix sums of a polynomial modulo 2**64, so every word and every shingle costs
a few array operations, whatever its length.

Edge cases: null and blank texts have no words and no shingles; a text with
fewer words than ``k`` has one shingle, its whole word sequence.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BASE = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0xD6E8FEB86659FD93)
#: Text that is hashed at once; its arrays take about 60 times as much.
CHUNK_BYTES = 1 << 18
#: Rows of a chunk at most: what is kept per row is bounded for short texts too.
CHUNK_ROWS = 256

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _inverse(a: int) -> int:
    return pow(a, -1, 1 << 64)


_BASE_INV = np.uint64(_inverse(int(BASE)))


class _Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            up = np.full(size, BASE, dtype=np.uint64)
            down = np.full(size, _BASE_INV, dtype=np.uint64)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up), np.cumprod(down)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def text_chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) of consecutive rows of at most ``limit``
    bytes together and at most CHUNK_ROWS; a longer row comes alone and whole.
    Nulls have no bytes."""
    pa.default_memory_pool().release_unused()  # of earlier batches; workers live on between stages
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if len(column) == 0:
        return
    _, offsets_buf, data_buf = column.buffers()
    offsets = np.frombuffer(offsets_buf, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_buf, dtype=np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1)
        last = min(last, len(column), first + CHUNK_ROWS)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word of a chunk, in order."""
    n = len(data)
    if n == 0:
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = ~_SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    cuts = offsets[:-1][offsets[:-1] < n]
    first[cuts] = inside[cuts]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | first[1:]
    start = np.flatnonzero(first)
    end = np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word [start, end) of lower-cased ``data``."""
    if len(start) == 0:
        return np.zeros(0, np.uint64)
    up, down = _powers.get(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    return mix64((total[end] - total[start]) * down[start])


def shingle_hashes(word: np.ndarray, row: np.ndarray, n_rows: int, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the k-word shingles of each row, with repeats; a row of
    1..k-1 words has one shingle of all of them."""
    count = np.bincount(row, minlength=n_rows) if len(row) else np.zeros(n_rows, np.int64)
    n = len(word)
    starts = np.concatenate([[0], np.cumsum(count)[:-1]]) if n_rows else np.zeros(0, np.int64)
    short = (count > 0) & (count < k)
    parts, rows = [], []
    if n >= k:
        value = np.zeros(n - k + 1, dtype=np.uint64)
        for j in range(k):
            value = value * STEP + word[j : n - k + 1 + j]
        whole = row[: n - k + 1] == row[k - 1 :]
        parts.append(mix64(value[whole] + np.uint64(k)))
        rows.append(row[: n - k + 1][whole])
    for length in range(1, k):
        at = np.flatnonzero(short & (count == length))
        if len(at):
            value = np.zeros(len(at), dtype=np.uint64)
            for j in range(length):
                value = value * STEP + word[starts[at] + j]
            parts.append(mix64(value + np.uint64(length)))
            rows.append(at)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    value, where = np.concatenate(parts), np.concatenate(rows)
    if short.any():
        order = np.argsort(where, kind="stable")
        value, where = value[order], where[order]
    return value, where


def text_shingles(data: np.ndarray, offsets: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the distinct k-word shingles of a chunk, sorted by row
    and then by hash."""
    lower = _LOWER[data]
    start, end, row = words(lower, offsets)
    value, where = shingle_hashes(word_hashes(lower, start, end), row, len(offsets) - 1, k)
    return distinct_by_row(value, where)


def distinct_by_row(value: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((value, where))
    value, where = value[order], where[order]
    if len(value):
        keep = np.ones(len(value), dtype=bool)
        keep[1:] = (value[1:] != value[:-1]) | (where[1:] != where[:-1])
        value, where = value[keep], where[keep]
    return value, where
