"""Sorting suffixes by hashed comparison.

Prefix polynomial hashes tell whether two stretches of a buffer are equal in one step, so a binary
search finds how far two suffixes agree in a logarithmic number of steps, and a mergesort puts them
in order. Everything is vectorised: all comparisons of a merge step are made at once.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``BASE`` to the 0..n-1, and its inverse to the same, modulo 2**64."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16)
        for name, factor in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, factor)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"][:n], _powers["down"][:n]


class Hashed:
    """Prefix hashes of a buffer of bytes."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, dtype=np.uint64)
        # from 1, so that zero bytes count
        np.cumsum((data + np.uint64(1)) * up[:-1], out=self.sums[1:])

    def of(self, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.sums[begin + length] - self.sums[begin]) * self.down[begin]

    def agree_right(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes from x and from y on agree, at most ``most``."""
        return self._agree(x, y, most, 0)

    def agree_left(self, x: np.ndarray, y: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many bytes before x and before y agree."""
        return self._agree(x, y, most, 1)

    def _agree(self, x, y, most, back):
        low, high = np.zeros_like(most), most.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            middle = (low[open_] + high[open_] + 1) // 2
            a, b = x[open_] - back * middle, y[open_] - back * middle
            same = self.of(a, middle) == self.of(b, middle)
            low[open_] = np.where(same, middle, low[open_])
            high[open_] = np.where(same, high[open_], middle - 1)


def merge_sort(data: np.ndarray, hashed: Hashed, begin: np.ndarray, end: np.ndarray,
               group: np.ndarray) -> np.ndarray:
    """Order of the suffixes ``data[begin:end]`` inside their groups, which lie together.

    Runs are merged by rank: the place of a suffix is its place in its own run plus the number of
    suffixes of the other run before it, found by binary search.
    """
    n = len(begin)
    order = np.arange(n)
    first = np.searchsorted(group, group, side="left")
    last = np.searchsorted(group, group, side="right")
    place = np.arange(n)
    width = 1
    while n and width < (last - first).max():
        offset = place - first
        pair = first + offset // (2 * width) * (2 * width)
        odd = (offset // width) % 2 == 1
        low = np.where(odd, pair, np.minimum(pair + width, last))
        high = np.where(odd, pair + width, np.minimum(pair + 2 * width, last))
        start = low.copy()
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                break
            middle = (low[open_] + high[open_]) // 2
            sign = _compare(data, hashed, begin, end, order[middle], order[open_])
            # equal ones of the left run come first
            before = (sign < 0) | ((sign == 0) & odd[open_])
            low[open_] = np.where(before, middle + 1, low[open_])
            high[open_] = np.where(before, high[open_], middle)
        own = place - np.where(odd, np.minimum(pair + width, last), pair)
        merged = np.empty(n, dtype=np.int64)
        merged[pair + own + low - start] = order
        order = merged
        width *= 2
    return order


def _compare(data, hashed, begin, end, x, y) -> np.ndarray:
    size_x, size_y = end[x] - begin[x], end[y] - begin[y]
    short = np.minimum(size_x, size_y)
    agree = hashed.agree_right(begin[x], begin[y], short)
    at = np.minimum(agree, np.maximum(short - 1, 0))
    byte = data[begin[x] + at].astype(np.int64) - data[begin[y] + at]
    return np.where(agree < short, np.sign(byte), np.sign(size_x - size_y))
