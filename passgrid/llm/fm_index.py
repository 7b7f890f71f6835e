"""An FM-index over a sequence of symbols: suffix array, wavelet matrix of its transform, sampled positions."""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes by prefix doubling. Symbol 0 ends a segment; each end is a symbol of its own, in order of
    position, so that no comparison goes beyond its segment."""
    n = len(symbols)
    ends = symbols == 0
    rank = np.where(ends, np.cumsum(ends) - 1, symbols + int(ends.sum())).astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: max(0, n - width)] = rank[width:] + 1
        key = rank * (int(rank.max(initial=0)) + 2 + n) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.concatenate([[False], ordered[1:] != ordered[:-1]])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(fresh)
        if n == 0 or rank[order[-1]] == n - 1:
            return order
        width *= 2


class WaveletMatrix:
    """Rank of any symbol at any position, one bit vector a level."""

    def __init__(self, values: np.ndarray):
        self.levels = max(1, int(values.max(initial=0)).bit_length())
        self.ones: list[np.ndarray] = []
        self.zeros: list[int] = []
        for level in range(self.levels - 1, -1, -1):
            bit = (values >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[bit == 0], values[bit == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        begin = np.zeros(len(at), np.int64)
        at = at.astype(np.int64)
        for i in range(self.levels):
            ones, zeros = self.ones[i], self.zeros[i]
            bit = ((symbols >> (self.levels - 1 - i)) & 1).astype(bool)
            begin = np.where(bit, zeros + ones[begin], begin - ones[begin])
            at = np.where(bit, zeros + ones[at], at - ones[at])
        return at - begin


class FMIndex:
    """Index of segments of symbols 1, 2, ..., each ended by 0."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        self.bwt = symbols[order - 1].astype(np.int64)
        self.tree = WaveletMatrix(self.bwt)
        counts = np.bincount(symbols, minlength=int(symbols.max(initial=0)) + 2)
        self.before = np.concatenate([[0], np.cumsum(counts)])
        # A walk back must not cross the end of another segment, so segments' first positions are sampled too.
        sampled = (order % SAMPLE == 0) | (symbols[order - 1] == 0)
        self.sampled = np.where(sampled, order, -1)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search of all patterns at once (a row each, padded at the end); the rows ``low:high`` of suffixes
        that begin with it."""
        low = np.zeros(len(patterns), np.int64)
        high = np.full(len(patterns), len(self.bwt), np.int64)
        for back in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((lengths > back) & (low < high))
            symbol = patterns[live, lengths[live] - 1 - back].astype(np.int64)
            known = symbol < len(self.before) - 2
            first = self.before[np.where(known, symbol, 0)]
            symbol = np.where(known, symbol, 0)
            low[live] = np.where(known, first + self.tree.rank(symbol, low[live]), 0)
            high[live] = np.where(known, first + self.tree.rank(symbol, high[live]), 0)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffixes, walking back to a sampled one."""
        at, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
        walking = np.flatnonzero(self.sampled[at] < 0)
        while len(walking):
            symbol = self.bwt[at[walking]]
            at[walking] = self.before[symbol] + self.tree.rank(symbol, at[walking])
            steps[walking] += 1
            walking = walking[self.sampled[at[walking]] < 0]
        return self.sampled[at] + steps
