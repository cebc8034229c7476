"""Vectorised tokenisation of Arrow text columns.

Words are maximal runs of bytes other than space and 9..13.  A word is
represented by a 64-bit hash of its bytes, computed for a whole batch with
array operations (no Python string per word).  Memory is proportional to the
slice being processed: slices hold ``SLICE_BYTES`` of text, or one document
if that is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

# --- fixed values: odd 64-bit multipliers of the hashes ------------------------
BASE = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
LANES = (0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    if "p" not in _POWERS or len(_POWERS["p"]) < n:
        n = max(n, SLICE_BYTES)
        for name, b in (("p", BASE), ("q", pow(BASE, -1, 1 << 64))):
            v = np.full(n, b, dtype=np.uint64)
            v[0] = 1
            _POWERS[name] = np.multiply.accumulate(v)
    return _POWERS["p"], _POWERS["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the word (a bijection)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(MIX[1])
    return h ^ (h >> np.uint64(31))


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and document offsets of a text column; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def slices(offsets: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of documents of about ``size`` bytes (one document at least)."""
    size, i, n = size or SLICE_BYTES, 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + size, side="right")) - 1
        j = min(n, max(i + 1, j))
        yield i, j
        i = j


class Words:
    """Words of a slice: start and end byte, and the document offsets
    ``doc`` (words of document d are ``doc[d]:doc[d+1]``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False):
        self.bytes = _LOWER[data] if lower else data
        n = len(data)
        word = np.empty(n + 1, dtype=bool)
        np.logical_not(_SPACE[self.bytes], out=word[:n])
        word[n] = False
        cut = np.zeros(n + 1, dtype=bool)
        cut[offsets] = True
        first = word.copy()
        first[1:] &= ~word[:-1] | cut[1:]
        last = word[:-1] & (~word[1:] | cut[1:])
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.doc = np.searchsorted(self.start, offsets)
        self.inside = word[:n]

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word: a polynomial of its bytes, finalised
        together with the word's length."""
        if not len(self.start):
            return np.zeros(0, np.uint64)
        p, q = _powers(len(self.bytes) + 1)
        v = (self.bytes.astype(np.uint64) + np.uint64(1)) * p[:len(self.bytes)]
        v[~self.inside] = 0
        h = np.add.reduceat(v, self.start) * q[self.start]
        return mix(h + (self.end - self.start).astype(np.uint64) * np.uint64(LANES[0]))

    def owner(self) -> np.ndarray:
        """Document index of each word."""
        return np.repeat(np.arange(len(self.doc) - 1), np.diff(self.doc))


def shingles(h: np.ndarray, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``width`` consecutive words, with document offsets.  A
    document of fewer words (but at least one) has one shingle of them all;
    one without words has none."""
    count = np.diff(doc)
    out = np.zeros(len(h), np.uint64)
    for j in range(width):
        if j < len(h):
            out[:len(h) - j] += h[j:] * np.uint64(LANES[j % len(LANES)] + 2 * (j // len(LANES)))
    keep = np.zeros(len(h) + 1, np.int64)
    full = np.maximum(count - width + 1, 0)
    for a, n in zip(doc[:-1][full > 0], full[full > 0]):
        keep[a] += 1
        keep[a + n] -= 1
    for d in np.flatnonzero((count > 0) & (count < width)):
        own = h[doc[d]:doc[d + 1]]
        with np.errstate(over="ignore"):
            out[doc[d]] = sum((x * np.uint64(LANES[j % len(LANES)] + 2 * (j // len(LANES))) for j, x in enumerate(own)),
                              np.uint64(count[d]))
        keep[doc[d]] += 1
        keep[doc[d] + 1] -= 1
    kept = np.cumsum(keep[:-1]) > 0
    n = np.where(count >= width, full, np.minimum(count, 1))
    return mix(out[kept]), np.concatenate([[0], np.cumsum(n)])
