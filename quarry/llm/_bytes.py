"""UTF-8 columns as numpy byte arrays: words, lines and their 64-bit hashes, without a Python loop per word.

Hashes are sums of a random 64-bit value per byte times a power of an odd
multiplier, mixed at the end: two different strings collide with a chance of
about 2^-63, which the operators accept as equality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
BLOCK_ROWS = 1 << 16
SHINGLE_WORDS = 5

_MULT = 0x9E3779B97F4A7C15  # odd
_INV = pow(_MULT, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COMBINE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}

# Bytes that end a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
NEWLINE = (0x0A,)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``most`` bytes and at most BLOCK_ROWS rows; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1
        j = min(max(j, i + 1), i + BLOCK_ROWS, n)
        yield i, j
        i = j


def powers(n: int, base: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64; kept for the next call."""
    p = _powers.get(base)
    if p is None or len(p) < n:
        size = 1 << max(16, (n - 1).bit_length())
        p = np.empty(size, np.uint64)
        p[0] = 1
        done = 1
        while done < size:
            step = np.uint64(pow(base, done, 1 << 64))
            p[done:2 * done] = p[:done] * step
            done *= 2
        _powers[base] = p
    return p[:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xC2B2AE3D27D4EB4F)
    return h ^ (h >> np.uint64(32))


def _values(separators: tuple[int, ...], lower: bool) -> np.ndarray:
    t = _BYTE.copy()
    if lower:
        t[65:91] = t[97:123]
    t[list(separators)] = 0
    return t


def spans(data: np.ndarray, offsets: np.ndarray, separators: tuple[int, ...] = SPACES):
    """Starts and ends of the maximal separator-free runs, and the first run of every row (with an end entry)."""
    solid = np.ones(256, bool)
    solid[list(separators)] = False
    inside = solid[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1] | edge[1:n]
        last[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, separators: tuple[int, ...] = SPACES,
                lower: bool = False) -> np.ndarray:
    """Hash of the run that begins at each start; bytes between the runs must be separators."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    x = _values(separators, lower)[data]
    x *= powers(len(data), _MULT)
    sums = np.add.reduceat(x, starts)
    return mix(sums * powers(len(data), _INV)[starts])


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False):
    """Word hashes of a block, and the first word of each row (with an end entry)."""
    starts, _, rows = spans(data, offsets)
    return span_hashes(data, starts, lower=lower), rows


def row_blocks(column, most: int = BLOCK_BYTES):
    """(first row, last row, bytes, offsets) for blocks of whole rows of a column."""
    data, offsets = utf8(column)
    for i, j in blocks(offsets, most):
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]


def windows(h: np.ndarray, rows: np.ndarray, width: int, picked: tuple[int, ...] | None = None):
    """Hashes of all windows of ``width`` items that lie in one row (of the picked items only, if given);
    their start items; and the first window of each row (with an end entry)."""
    n = len(h)
    counts = np.diff(rows)
    many = np.maximum(counts - width + 1, 0)
    at = np.zeros(len(rows), np.int64)
    np.cumsum(many, out=at[1:])
    if n < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), at
    total = np.zeros(n - width + 1, np.uint64)
    for k in range(width) if picked is None else picked:
        total += h[k:n - width + 1 + k] * _COMBINE[k]
    begin = np.repeat(rows[:-1] - at[:-1], many) + np.arange(at[-1])
    return mix(total[begin]), begin, at
