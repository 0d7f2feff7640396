"""Vectorised word and shingle hashing for numpy code inside Spark tasks.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]`` of the UTF-8 text; as
those separators are ASCII, byte runs and code-point runs are the same words.
Hashes are 64-bit and depend on nothing but the bytes, so every task and every
rerun gets the same value.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SEPARATOR = np.zeros(256, dtype=bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int):
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def word_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets (begin, end) of every word; ``starts`` are the offsets at which texts begin."""
    inside = ~SEPARATOR[data]
    n = len(inside)
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    edge = starts[starts < n]
    begin[edge] = inside[edge]
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    last = edge[edge > 0] - 1
    stop[last] = inside[last]
    return np.flatnonzero(begin), np.flatnonzero(stop) + 1


def word_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word from one running polynomial over the bytes."""
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    up, down = _POWERS.upto(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    own = (total[end] - total[begin]) * down[begin]
    return mix64(own + (end - begin).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def rolling(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of ``n`` consecutive words (empty when there are fewer)."""
    count = len(hashes) - n + 1
    if count <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(count, dtype=np.uint64)
    for k in range(n):
        out = out * np.uint64(0xC2B2AE3D27D4EB4F) + hashes[k:k + count]
    return mix64(out + np.uint64(n))


def text_blocks(column: pa.Array, limit: int = 1 << 19):
    """Cut a string column into runs of rows of about ``limit`` bytes.

    Yields ``(first_row, offsets, data)``: ``offsets`` (one more than the rows)
    point into ``data``, the rows' UTF-8 bytes; a NULL text has no bytes. A text
    longer than ``limit`` is a run of its own, never cut.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    rows = len(column)
    if not rows:
        return
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + rows + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = int(np.searchsorted(off, off[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, off[first:last + 1] - off[first], raw[off[first]:off[last]]
        first = last


def block_words(offsets: np.ndarray, data: np.ndarray, lower: bool = False):
    """Words of a run of texts: ``(hashes, begin, end, bounds)``.

    ``bounds`` has one more entry than the texts: text i owns words
    ``bounds[i]:bounds[i + 1]``.
    """
    if lower:
        data = LOWER[data]
    begin, end = word_spans(data, offsets[:-1])
    bounds = np.searchsorted(begin, offsets)
    return word_hashes(data, begin, end), begin, end, bounds


def shingle_set(hashes: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of a text's word windows; a shorter text is one shingle, no words none."""
    if not len(hashes):
        return np.zeros(0, dtype=np.uint64)
    return np.unique(rolling(hashes, min(n, len(hashes))))
