"""Vectorised word and n-gram hashing over Arrow string buffers.

All functions take whole batches; the Python loop is over blocks of about a
megabyte, never over words.  Words are maximal runs of bytes other than
``\\x20 \\x09-\\x0D``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BLOCK = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_GRAM = np.uint64(0xD6E8FEB86659FD93)
_TABLE = np.random.default_rng(20240501).integers(0, 2**64, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: All ASCII but letters and digits: separators that also drop punctuation.
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER_TABLE = _TABLE[_LOWER]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xE9846AF9B1A615D)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xE9846AF9B1A615D)
    return x ^ (x >> np.uint64(28))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col, "").cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    raw = col.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = int(off[0]) if len(off) else 0
    return data[lo : int(off[-1]) if len(off) else 0], off - lo


def slices(col: pa.Array, most: int = 2 * _BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes of text, one row at least."""
    n = pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(n)
    lo = 0
    while lo < len(n):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, "right")))
        yield lo, hi
        lo = hi


def _beside_wide(data: np.ndarray) -> np.ndarray:
    """Bytes that begin a character which is, or follows, one from U+0800 on."""
    lead = (data & 0xC0) != 0x80
    of = np.cumsum(lead) - 1
    wide = (data[lead] >= 0xE0)[np.maximum(of, 0)]
    out = lead & wide
    out[1:] |= lead[1:] & wide[:-1]
    return out


class Words:
    """Words of a slice: byte ``start``/``end``, the row ``first`` indexes and a 64-bit ``hash``.

    With ``split_wide``, characters from U+0800 on (of scripts that set no
    spaces, among others) are words of their own.
    """

    def __init__(self, col: pa.Array, lower: bool, space: np.ndarray = _SPACE, split_wide: bool = False):
        data, off = text_buffers(col)
        self.data, self.off = data, off
        word = ~space[data]
        edge = off[:-1][off[:-1] < off[1:]]
        before = np.zeros(len(data), bool)
        before[1:] = word[:-1]
        before[edge] = False
        first = word & ~before
        if split_wide and len(data) and data.max() >= 0xE0:
            first |= word & _beside_wide(data)
        self.start = np.flatnonzero(first)
        after = np.zeros(len(data), bool)
        after[:-1] = word[1:] & ~first[1:]
        after[edge[edge > 0] - 1] = False
        self.end = np.flatnonzero(word & ~after) + 1
        #: Index of each row's first word, and the total at the end.
        self.first = np.searchsorted(self.start, off, "left")
        self.row = np.repeat(np.arange(len(off) - 1), np.diff(self.first))
        self.hash = self._hash(_LOWER_TABLE if lower else _TABLE)

    def _hash(self, table: np.ndarray) -> np.ndarray:
        start, end, data = self.start, self.end, self.data
        out = np.empty(len(start), np.uint64)
        lo = 0
        while lo < len(start):
            hi = max(lo + 1, int(np.searchsorted(end, start[lo] + _BLOCK, "right")))
            at = int(start[lo])
            value = table[data[at : end[hi - 1]]]
            up, down = _powers(len(value))
            total = np.zeros(len(value) + 1, np.uint64)
            np.cumsum(value * up, out=total[1:])
            s, e = start[lo:hi] - at, end[lo:hi] - at
            out[lo:hi] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64) * _ODD)
            lo = hi
        return out

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the ``n`` words from each word on, and whether they lie in one row."""
        h = self.hash
        m = max(0, len(h) - n + 1)
        out = np.zeros(m, np.uint64)
        for j in range(n):
            out *= _GRAM
            out += h[j : j + m]
        inside = self.row[:m] == self.row[n - 1 : n - 1 + m] if m else np.zeros(0, bool)
        return mix(out), inside

    def whole(self, row: int) -> np.uint64:
        """Hash of all words of a row."""
        h = self.hash[self.first[row] : self.first[row + 1]]
        out = np.uint64(len(h))
        with np.errstate(over="ignore"):
            for x in h:
                out = out * _GRAM + x
        return mix(np.array([out], np.uint64))[0]


_up = np.ones(1, np.uint64)
_down = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n-1 of an odd factor and of its inverse modulo 2^64."""
    global _up, _down
    if len(_up) < n:
        inverse = pow(int(_ODD), -1, 1 << 64)
        for name, x in (("_up", _ODD), ("_down", np.uint64(inverse))):
            a = np.full(n, x, np.uint64)
            a[0] = 1
            globals()[name] = np.cumprod(a, dtype=np.uint64)
    return _up[:n], _down[:n]
