"""Vectorised words: whole Arrow batches of texts become arrays of word spans and 64-bit hashes.

All arithmetic is modulo 2**64, so a word has the same hash on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text handled at once; a longer single text is handled alone. Arrays of about 40 times as much are held meanwhile.
SLICE_BYTES = 1 << 18
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15 * 8 + 5 & (2**64 - 1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift and multiply)."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


_TABLE = mix((np.arange(256, dtype=U) + U(1)) * U(0x9E3779B97F4A7C15))


class Powers:
    """Powers of an odd base and of its inverse, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, U)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, b in (("up", self.base), ("down", self.inverse)):
                a = np.full(size, U(b))
                a[0] = U(1)
                setattr(self, name, np.cumprod(a, dtype=U))
        return self.up, self.down


_BYTES = Powers(_BASE)


class Words(NamedTuple):
    """Of some consecutive texts: rows first..first+n; words in order, ``bounds[r]:bounds[r+1]`` of row r."""

    first: int
    n: int
    bounds: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    data: np.ndarray


def slices(texts: pa.Array, lower: bool, size: int = SLICE_BYTES) -> Iterator[Words]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of each text, about ``size`` bytes at once; null counts as empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    rows = len(texts)
    if not rows:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + rows + 1]
    whole = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        data = whole[offsets[at] : offsets[to]]
        if lower:
            data = _LOWER[data]
        yield _words(at, data, offsets[at : to + 1] - offsets[at])
        at = to


def _words(first: int, data: np.ndarray, offsets: np.ndarray) -> Words:
    n, size = len(offsets) - 1, len(data)
    solid = np.zeros(size + 2, bool)
    solid[1:-1] = ~_SPACE[data]
    begins = solid[1:-1] & ~solid[:-2]
    ends = solid[1:-1] & ~solid[2:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < size)]  # a text's end ends its last word
    cut = inner[solid[inner + 1] & solid[inner]]
    begins[cut] = True
    ends[cut - 1] = True
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    up, down = _BYTES.upto(size + 1)
    total = np.zeros(size + 1, U)
    np.cumsum(_TABLE[data] * up[:size], out=total[1:])
    h = mix((total[end] - total[start]) * down[start] ^ (end - start).astype(U))
    return Words(first, n, np.searchsorted(start, offsets), h, start, end, data)


def windows(h: np.ndarray, width: int, powers: Powers) -> np.ndarray:
    """The hash of each ``width`` consecutive elements; element i starts window i."""
    n = len(h)
    if n < width:
        return np.zeros(0, U)
    up, down = powers.upto(n + 1)
    total = np.zeros(n + 1, U)
    np.cumsum(h * up[:n], out=total[1:])
    return mix((total[width:] - total[:-width]) * down[: n - width + 1])


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
