"""FM-index over a sequence of small integers, for one shard of a text."""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Rank queries over symbols below ``2 ** levels`` by one bit vector a level."""

    def __init__(self, symbols: np.ndarray, levels: int):
        self.levels, self.ones, self.zeros = levels, [], []
        for k in reversed(range(levels)):
            bit = ((symbols >> k) & 1).astype(bool)
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.ones.append(ones)
            self.zeros.append(len(symbols) - int(ones[-1]))
            symbols = np.concatenate((symbols[~bit], symbols[bit]))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (ones, zeros) in enumerate(zip(self.ones, self.zeros)):
            up = ones[at]
            at = np.where((symbol >> (self.levels - 1 - k)) & 1, zeros + up, at - up)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, at) - self._down(symbol, np.zeros_like(at))


class FMIndex:
    """Backward search in ``text``, symbols from 1 up; 0 separates stretches and matches nothing.

    Every ``step``-th suffix position is kept, and the first of each stretch, so a walk to
    a kept position never crosses a separator.
    """

    def __init__(self, text: np.ndarray, size: int, step: int = 16):
        if not len(text) or text[-1]:
            text = np.append(text, 0)
        n = len(text)
        self.text_length = n
        order = _suffix_order(text)
        before = np.empty(n, text.dtype)
        before[:] = text[order - 1]
        before[order == 0] = 0
        self.last = before
        self.tree = WaveletMatrix(before, max(1, int(size).bit_length()))
        counts = np.bincount(text, minlength=size + 1)
        self.first = np.concatenate(([0], np.cumsum(counts))).astype(np.int64)
        kept = (order % step == 0) | (before == 0)
        self.kept = kept
        self.sample = order[kept]
        self.sample_rank = np.cumsum(kept) - 1

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows of the suffix order for the patterns that occur: pattern, first row, end row.

        ``patterns`` is left-padded with zeros to one width.
        """
        width = patterns.shape[1]
        alive = np.arange(len(patterns))
        lo, hi = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.text_length, np.int64)
        for k in range(width):
            symbol = patterns[alive, width - 1 - k]
            going = lengths[alive] > k
            new_lo = np.where(going, self.first[symbol] + self.tree.rank(symbol, lo), lo)
            new_hi = np.where(going, self.first[symbol] + self.tree.rank(symbol, hi), hi)
            some = new_lo < new_hi
            alive, lo, hi = alive[some], new_lo[some], new_hi[some]
            if not len(alive):
                break
        return alive, lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to the nearest kept position."""
        out = np.zeros(len(rows), np.int64)
        todo, walked = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(todo):
            done = self.kept[rows]
            out[todo[done]] = self.sample[self.sample_rank[rows[done]]] + walked
            todo, rows = todo[~done], rows[~done]
            symbol = self.last[rows]
            rows = self.first[symbol] + self.tree.rank(symbol, rows)
            walked += 1
        return out


def _suffix_order(text: np.ndarray) -> np.ndarray:
    """Suffix positions in order, by prefix doubling. Separators count as all different, so the
    number of rounds depends on the longest stretch only."""
    n = len(text)
    zero = text == 0
    rank = text.astype(np.int64) + n
    rank[zero] = np.arange(int(zero.sum()))
    order = np.argsort(rank, kind="stable")
    width = 1
    while True:
        sorted_rank = rank[order]
        fresh = np.concatenate(([True], sorted_rank[1:] != sorted_rank[:-1]))
        dense = np.cumsum(fresh) - 1
        rank = np.empty(n, np.int64)
        rank[order] = dense
        if dense[-1] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1
        rank = rank * (n + 1) + after
        # Only suffixes that share their rank move; their places are already right as a group.
        alone = fresh & np.concatenate((fresh[1:], [True]))
        tied = np.flatnonzero(~alone)
        spot = order[tied]
        order[tied] = spot[np.argsort(rank[spot], kind="stable")]
        width *= 2
