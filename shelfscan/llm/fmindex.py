"""An FM-index over a sequence of small integers, with vectorised search.

The suffix array is built by prefix doubling, ranks come from a wavelet matrix (one bit vector with
running counts per bit of a symbol), and suffix positions are sampled every ``SAMPLE`` places.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_array(sequence: np.ndarray) -> np.ndarray:
    n = len(sequence)
    _, rank = np.unique(sequence, return_inverse=True)
    rank = rank.astype(np.int64)
    width = 1
    while True:
        after = np.zeros(n, dtype=np.int64)
        after[:n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (n + 1) + after
        order = np.argsort(key, kind="stable")
        changed = np.diff(key[order], prepend=-1) != 0
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(changed) - 1
        if changed.all() or width >= n:
            return order
        width *= 2


class WaveletMatrix:
    """Rank of a symbol in a prefix, for many symbols and prefixes at once."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.bits = max(1, int(symbols - 1).bit_length())
        self.levels: list[tuple[np.ndarray, int]] = []
        for bit in range(self.bits - 1, -1, -1):
            ones = (sequence >> bit) & 1
            before = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((before, len(sequence) - int(before[-1])))
            sequence = np.concatenate((sequence[ones == 0], sequence[ones == 1]))

    def rank(self, symbol: np.ndarray, end: np.ndarray) -> np.ndarray:
        begin = np.zeros_like(end)
        for level, (before, zeros) in enumerate(self.levels):
            one = (symbol >> (self.bits - 1 - level)) & 1 == 1
            ones_begin, ones_end = before[begin], before[end]
            begin = np.where(one, zeros + ones_begin, begin - ones_begin)
            end = np.where(one, zeros + ones_end, end - ones_end)
        return end - begin


class FmIndex:
    """``sequence`` holds integers from 1 to ``symbols`` - 1; 0 ends it."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        whole = np.append(sequence.astype(np.int64), 0)
        order = suffix_array(whole)
        self.last = whole[order - 1]
        self.ranks = WaveletMatrix(self.last, symbols)
        self.first = np.concatenate(([0], np.cumsum(np.bincount(whole, minlength=symbols))))
        kept = order % SAMPLE == 0
        self.kept_before = np.concatenate(([0], np.cumsum(kept)))
        self.kept = kept
        self.positions = order[kept]

    def ranges(self, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges of the rows of ``patterns``, all of one length."""
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.full(len(patterns), len(self.last), dtype=np.int64)
        alive = np.arange(len(patterns))
        for at in range(patterns.shape[1] - 1, -1, -1):
            symbol = patterns[alive, at]
            low[alive] = self.first[symbol] + self.ranks.rank(symbol, low[alive])
            high[alive] = self.first[symbol] + self.ranks.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Positions in the sequence of suffixes given by their rank."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(open_):
            hit = self.kept[rows[open_]]
            done = open_[hit]
            found[done] = self.positions[self.kept_before[rows[done]]] + steps
            open_ = open_[~hit]
            symbol = self.last[rows[open_]]
            rows[open_] = self.first[symbol] + self.ranks.rank(symbol, rows[open_])
            steps += 1
        return found
