"""Vectorised words and hashes of whole Arrow text columns.

A text column is walked in slices of rows; a slice is one byte buffer in which
numpy finds words and hashes them, so there is no Python object per word. Texts
are never cut: a slice ends at a row's end, however long the row.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
SPACES = b" \t\n\x0b\x0c\r"


def space_table() -> np.ndarray:
    """True for the bytes that separate words `[^\\x20\\x09-\\x0D]+`."""
    table = np.zeros(256, bool)
    table[list(SPACES)] = True
    return table


def non_word_table() -> np.ndarray:
    """True for ASCII bytes that are neither letters nor digits; other bytes belong to words."""
    table = np.ones(256, bool)
    table[128:] = False
    for a, b in ((48, 58), (65, 91), (97, 123)):
        table[a:b] = False
    return table


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every input bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Words(NamedTuple):
    """Words of the rows `first` to `first + rows` of a column."""

    first: int
    rows: int
    data: np.ndarray  # bytes of the slice
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # one past its last byte
    offsets: np.ndarray  # words of row r: offsets[r] to offsets[r + 1]
    hashes: np.ndarray  # 64 bits for each word


def as_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a text column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    n = len(column)
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    return at, np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)


class Tokenizer:
    """Words and their hashes; keeps tables of powers between calls."""

    def __init__(self, separators: np.ndarray, slice_bytes: int = 1 << 20):
        self.separators, self.slice_bytes = separators, slice_bytes
        self.up, self.down = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def _tables(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, self.slice_bytes)
            self.up = powers(BASE, size)
            self.down = powers(np.uint64(pow(int(BASE), -1, 1 << 64)), size)

    def slices(self, column: pa.Array | pa.ChunkedArray) -> Iterator[Words]:
        at, data = as_bytes(column)
        n, row = len(at) - 1, 0
        while row < n:
            stop = max(row + 1, int(np.searchsorted(at, at[row] + self.slice_bytes, "right")) - 1)
            yield self._words(row, at[row:stop + 1] - at[row], data[at[row]:at[stop]])
            row = stop

    def _words(self, first: int, at: np.ndarray, data: np.ndarray) -> Words:
        n = len(data)
        self._tables(n)
        inside = ~self.separators[data]
        before = np.empty(n + 1, bool)  # whether a word could run on from the byte before
        before[0] = False
        before[1:] = inside
        before[at] = False
        starts = np.flatnonzero(inside & ~before[:n])
        after = np.empty(n + 1, bool)
        after[:n] = inside
        after[n] = False
        after[at] = False
        ends = np.flatnonzero(inside & ~after[1:]) + 1
        total = np.empty(n + 1, np.uint64)
        total[0] = 0
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=total[1:])
        hashes = mix((total[ends] - total[starts]) * self.down[starts])
        return Words(first, len(at) - 1, data, starts, ends, np.searchsorted(starts, at), hashes)


def window_hashes(hashes: np.ndarray, n: int, base: int) -> np.ndarray:
    """A hash for each run of `n` consecutive hashes, by doubling."""
    whole, whole_len, part, part_len = None, 0, hashes, 1
    while True:
        if n & part_len:
            if whole is None:
                whole, whole_len = part, part_len
            else:
                step = np.uint64(pow(base, whole_len, 1 << 64))
                m = max(len(part) - whole_len, 0)
                whole, whole_len = whole[:m] + step * part[whole_len:whole_len + m], whole_len + part_len
        if whole_len == n:
            return mix(whole[:max(len(hashes) - n + 1, 0)])
        step = np.uint64(pow(base, part_len, 1 << 64))
        m = max(len(part) - part_len, 0)
        part, part_len = part[:m] + step * part[part_len:part_len + m], 2 * part_len


def sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """`op` (minimum or maximum) over each run of `n` values, by doubling."""
    m = len(x) - n + 1
    if m <= 0:
        return x[:0]
    part, size = x, 1
    while 2 * size <= n:
        part, size = op(part[:-size], part[size:]), 2 * size
    return op(part[:m], part[n - size:n - size + m])


def windows_inside(offsets: np.ndarray, n: int, total: int) -> np.ndarray:
    """For each of the `total` word positions, whether `n` words from there lie in one row."""
    inside = np.ones(total + 1, bool)
    lengths = np.diff(offsets)
    # the last n - 1 positions of each row start no window
    tail = np.minimum(lengths, n - 1)
    edge = np.zeros(total + 1, np.int32)
    np.add.at(edge, offsets[1:] - tail, 1)
    np.add.at(edge, offsets[1:], -1)
    inside = np.cumsum(edge)[:total] == 0
    return inside
