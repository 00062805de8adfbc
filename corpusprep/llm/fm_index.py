"""FM-index over a sequence of symbols: wavelet-matrix ranks, vectorised backward search, sampled suffix positions."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes of ``symbols`` in order, by prefix doubling; the last symbol must be the only, smallest 0."""
    n = len(symbols)
    width = max(int(symbols.max()).bit_length(), 1)
    # The first key already packs several symbols, which saves the first rounds.
    reach = max(1, 62 // width)
    keys = np.zeros(n, np.int64)
    for k in range(reach):
        keys <<= width
        keys[: n - k] |= symbols[k:] if k < n else 0
    order = np.argsort(keys, kind="stable")
    rank = np.empty(n, np.int64)
    # Positions in ``order`` whose suffixes are not told apart yet; a group's rank is its first position.
    shared, ranked = np.arange(n), keys[order]
    while True:
        new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
        rank[order[shared]] = np.maximum.accumulate(np.where(new, shared, 0))
        alone = new & np.concatenate([new[1:], [True]])
        shared = shared[~alone]
        if not len(shared):
            return order
        suffixes = order[shared]
        after = suffixes + reach
        second = np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
        ranked = rank[suffixes] * (n + 1) + second
        by = np.argsort(ranked, kind="stable")
        order[shared], ranked = suffixes[by], ranked[by]
        reach *= 2


class WaveletMatrix:
    """Counts of a symbol in any prefix of a sequence, one bit level at a time."""

    def __init__(self, symbols: np.ndarray):
        self.levels = max(int(symbols.max()).bit_length(), 1)
        self.zeros_before, self.zeros = [], []
        current = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = (current >> level) & 1
            zeros = np.zeros(len(current) + 1, np.int32)
            np.cumsum(1 - bit, out=zeros[1:])
            self.zeros_before.append(zeros)
            self.zeros.append(int(zeros[-1]))
            current = np.concatenate([current[bit == 0], current[bit == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often ``symbols[i]`` occurs before position ``ends[i]``."""
        start, end = np.zeros_like(ends), ends
        for depth, level in enumerate(range(self.levels - 1, -1, -1)):
            zeros, one = self.zeros_before[depth], ((symbols >> level) & 1).astype(bool)
            start_zeros, end_zeros = zeros[start], zeros[end]
            start = np.where(one, self.zeros[depth] + start - start_zeros, start_zeros)
            end = np.where(one, self.zeros[depth] + end - end_zeros, end_zeros)
        return end - start


class FMIndex:
    """Index of symbols from 1 up; every ``sample``-th position of the sequence is kept with its suffix."""

    def __init__(self, symbols: np.ndarray, sample: int = 16):
        text = np.concatenate([symbols.astype(np.int64), [0]])
        order = suffix_array(text)
        self.size = len(text)
        self.bwt = text[order - 1]
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text))])
        self.ranks = WaveletMatrix(self.bwt)
        self.marked = order % sample == 0
        self.marks_before = np.concatenate([[0], np.cumsum(self.marked)])
        self.positions = order[self.marked]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ranges of suffixes that begin with each pattern; ``patterns`` is padded at the right, no length is 0."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size, np.int64)
        top = len(self.smaller) - 1
        for step in range(patterns.shape[1]):
            live = np.flatnonzero((step < lengths) & (low < high))
            if not len(live):
                break
            symbol = patterns[live, lengths[live] - 1 - step]
            known = symbol < top
            high[live[~known]] = low[live[~known]]
            live, symbol = live[known], symbol[known]
            low[live] = self.smaller[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.smaller[symbol] + self.ranks.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions of suffixes: walk backwards through the sequence to the next sampled one."""
        found, steps, at = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), rows.copy()
        open_rows = np.arange(len(rows))
        while len(open_rows):
            here = at[open_rows]
            done = self.marked[here]
            ended = open_rows[done]
            found[ended] = self.positions[self.marks_before[at[ended]]] + steps[ended]
            open_rows = open_rows[~done]
            here = at[open_rows]
            symbol = self.bwt[here]
            at[open_rows] = self.smaller[symbol] + self.ranks.rank(symbol, here)
            steps[open_rows] += 1
        return found
