"""Texts of an Arrow batch as byte arrays: words and hashes without a Python string per word.

Everything here works on the UTF-8 bytes that Arrow hands over, in slices of about a megabyte,
so memory follows the longest single text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def _table(inside: str) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(inside.encode())] = True
    return table


# Separators of words `[^\x20\x09-\x0D]+`.
WHITE = _table(" \t\n\v\f\r")
# Separators of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, applied after folding A-Z.
NOT_ALNUM = np.array([b < 0x80 and not (0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A) for b in range(256)])
IDENTITY = np.arange(256, dtype=np.uint8)
FOLD = IDENTITY.copy()
FOLD[65:91] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offsets of its rows; null counts as empty."""
    column = pc.fill_null(pc.cast(column, pa.large_utf8()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of whole rows of about ``limit`` bytes, one row at least."""
    if not len(column):
        return
    data, offsets = text_bytes(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        stop = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        stop = min(rows, max(row + 1, stop))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def word_bounds(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray):
    """Start, end and row of every word; words never cross rows."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~separator[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    row_starts = offsets[:-1][offsets[:-1] < len(data)]
    first[row_starts] = inside[row_starts]
    row_ends = offsets[1:][offsets[1:] > 0] - 1
    last[row_ends] = inside[row_ends]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of the multiplier and of its inverse, modulo 2**64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 1 << 64))):
            out = np.full(max(n, SLICE_BYTES + 64), base, np.uint64)
            out[0] = 1
            _powers[i] = np.multiply.accumulate(out)
    return _powers[0][:n], _powers[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(32)
    return x


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = IDENTITY) -> np.ndarray:
    """64-bit hashes of ascending, disjoint spans: a polynomial over random byte values, from prefix sums."""
    out = np.empty(len(starts), np.uint64)
    values = _byte_values()[fold]
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE_BYTES, "right")))
        low, high = starts[i], ends[j - 1]
        up, down = powers(int(high - low) + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(values[data[low:high]] * up[:-1], out=sums[1:])
        s, e = starts[i:j] - low, ends[i:j] - low
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


def words(data, offsets, separator=WHITE, fold=FOLD):
    """Hash and row of every word of the folded text."""
    data = fold[data]
    starts, ends, rows = word_bounds(data, offsets, separator)
    return span_hashes(data, starts, ends), rows


def row_bounds(rows: np.ndarray, n: int) -> np.ndarray:
    """Offsets of each of ``n`` rows in a sorted row number array."""
    return np.searchsorted(rows, np.arange(n + 1))
