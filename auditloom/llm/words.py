"""Hashes of the words of many texts at once, on the bytes of an Arrow column."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_ROOT = np.uint64(0x9E3779B97F4A7C15)
_BLOCK = 1 << 19


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash (a bijection, so equal hashes stay equal and others stay apart)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string column as one array, and n + 1 bounds; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8) if len(texts) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0]: bounds[-1]], bounds - bounds[0]


def slices(batch: pa.RecordBatch, column: str, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows of about ``size`` bytes of ``column``; every row is in one run."""
    ends = np.cumsum(np.diff(utf8(batch[column])[1]) + 64)
    start = 0
    while start < len(batch):
        stop = int(np.searchsorted(ends, (ends[start - 1] if start else 0) + size, side="right"))
        stop = max(stop, start + 1)
        yield batch.slice(start, stop - start)
        start = stop


class WordHasher:
    """Splits texts into words, runs of bytes outside ``separators``, and hashes each to 64 bits.

    A word's hash is a polynomial in the codes of its bytes; prefix sums give all words of a
    block without a loop over words. A-Z count as a-z. Separators are ASCII, so bytes of a
    UTF-8 sequence are never split.
    """

    def __init__(self, separators: bytes):
        code = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        code[65:91] = code[97:123]
        self.inside = np.ones(256, bool)
        self.inside[np.frombuffer(separators, np.uint8)] = False
        self.code = code
        self.up = self.down = np.ones(1, np.uint64)

    def _hash(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        first, n = starts[0], ends[-1] - starts[0]
        if len(self.up) <= n:
            self.up = _powers(_ROOT, n + _BLOCK)
            self.down = _powers(np.uint64(pow(int(_ROOT), -1, 1 << 64)), n + _BLOCK)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.code[raw[first: first + n]] * self.up[:n], out=total[1:])
        h = (total[ends - first] - total[starts - first]) * self.down[starts - first]
        return mix(h ^ ((ends - starts).astype(np.uint64) << np.uint64(40)))

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Hash of every word in order, and for each text the number of words before it
        (one entry more than texts). A null text has no words."""
        raw, bounds = utf8(texts)
        if not len(raw):
            return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        inside = self.inside[raw]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        finish = inside.copy()
        finish[:-1] &= ~inside[1:]
        cuts = np.unique(bounds[1:-1])
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        begins[cuts] |= inside[cuts]
        finish[cuts - 1] |= inside[cuts - 1]
        starts, ends = np.flatnonzero(begins), np.flatnonzero(finish) + 1
        out = np.zeros(len(starts), np.uint64)
        at = 0
        while at < len(starts):
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + _BLOCK, side="right")))
            out[at:to] = self._hash(raw, starts[at:to], ends[at:to])
            at = to
        return out, np.searchsorted(starts, bounds)
