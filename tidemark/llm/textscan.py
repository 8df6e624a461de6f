"""Vectorised scanning of UTF-8 text that lies in Arrow buffers.

Words are found and hashed with numpy over a bounded slice of a batch at a time, so
the memory of a task depends on the longest single text and not on the batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bytes of text that are held in numpy form at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (in a new array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and its n + 1 offsets. A null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_null(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES):
    """Ranges of rows whose texts together have at most ``limit`` bytes, or one row."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1))
        yield i, j
        i = j


def binary_array(rows: np.ndarray) -> pa.Array:
    """A binary column from the rows of a contiguous two-dimensional array."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


def ragged_array(values: np.ndarray, begin: np.ndarray) -> pa.Array:
    """A binary column whose row k holds ``values[begin[k] : begin[k + 1]]``."""
    offsets = (begin * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(begin) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


class WordScanner:
    """Finds the maximal runs of word bytes and hashes them, A-Z as a-z if ``fold``.

    ``separators`` are the byte values that are no part of a word; all are below 0x80,
    so a character is never cut.
    """

    #: Powers of the base, shared by the tasks that one worker runs in turn.
    _up = _down = np.zeros(0, np.uint64)

    def __init__(self, separators: bytes, fold: bool = True):
        self.is_word = np.ones(256, bool)
        self.is_word[list(separators)] = False
        self.value = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        if fold:
            self.value[65:91] = self.value[97:123]

    def split(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of the words, and for each row (and the end) its first word's index."""
        word = self.is_word[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        begin = word.copy()
        begin[1:] &= ~word[:-1] | edge[1:-1]
        end = word.copy()
        end[:-1] &= ~word[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
        return starts, ends, np.searchsorted(starts, offsets)

    def _powers(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self._up) < n:
            n = max(n, SLICE_BYTES + 1)
            for name, base in (("_up", _BASE), ("_down", pow(_BASE, -1, 1 << 64))):
                x = np.full(n, base & _MASK, np.uint64)
                x[0] = 1
                setattr(WordScanner, name, np.multiply.accumulate(x))
        return self._up, self._down

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges, in order and not overlapping; equal ranges are equal everywhere."""
        out = np.empty(len(starts), np.uint64)
        i = 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
            a, b = int(starts[i]), int(ends[j - 1])
            up, down = self._powers(b - a)
            sums = np.zeros(b - a + 1, np.uint64)
            np.cumsum(self.value[data[a:b]] * up[: b - a], out=sums[1:])
            out[i:j] = (sums[ends[i:j] - a] - sums[starts[i:j] - a]) * down[starts[i:j] - a]
            i = j
        return mix(out)


#: Separators of ``[^\x20\x09-\x0D]+`` and of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` (after A-Z became a-z).
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NON_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])

_SHINGLE = [np.uint64(pow(_BASE, 3 + 2 * i, 1 << 64) | 1) for i in range(64)]


def rows_of(first: np.ndarray) -> np.ndarray:
    """The row of each word, from the first word's index of each row."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def shingles(words: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted within each row, and each row's first index among them.

    A row with fewer words than ``width``, but not none, has its whole sequence as its only shingle.
    """
    counts = np.diff(first)
    per_row = np.where(counts >= width, counts - width + 1, (counts > 0).astype(counts.dtype))
    n = len(words)
    if n >= width:
        h = words[: n - width + 1] * _SHINGLE[0]
        for i in range(1, width):
            h += words[i : n - width + 1 + i] * _SHINGLE[i]
        row = rows_of(first)
        h = h[row[: n - width + 1] == row[width - 1 :]]
    else:
        h = np.zeros(0, np.uint64)
    begin = np.zeros(len(first), np.int64)
    np.cumsum(per_row, out=begin[1:])
    out = np.empty(begin[-1], np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    fill = np.ones(len(out), bool)
    fill[begin[short]] = False
    out[fill] = h
    for r in short:
        w = words[first[r] : first[r + 1]]
        out[begin[r]] = (w * np.array(_SHINGLE[32 : 32 + len(w)])).sum(dtype=np.uint64) + np.uint64(len(w))
    out = mix(out)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        if b - a > 1:
            out[a:b].sort()
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[begin[:-1][per_row > 0]] = True
    kept = np.zeros(len(out) + 1, np.int64)
    np.cumsum(new, out=kept[1:])
    return out[new], kept[begin]
