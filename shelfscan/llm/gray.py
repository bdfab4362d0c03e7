"""A hierarchical index over 64-bit fingerprints in Gray order.

Fingerprints that differ in few bits tend to lie close in the order of their Gray rank. Runs of
``FAN`` neighbours form a node, runs of nodes a node above. A node holds the bits on which all below
it agree and which its parent does not hold yet. A search adds up the differences on the way down
and leaves a whole group when they exceed the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

FAN = 8
#: Queries that go down the index together.
TOGETHER = 4096


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The place of each code in the Gray sequence."""
    rank = codes.astype(np.uint64)
    for shift in (1, 2, 4, 8, 16, 32):
        rank = rank ^ (rank >> np.uint64(shift))
    return rank


class GrayIndex:
    """Groups of fingerprints; ``order`` sorts the input by group, then Gray rank."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        codes = codes.astype(np.uint64)
        self.order = np.lexsort((gray_rank(codes), groups))
        self.codes, groups = codes[self.order], groups[self.order]
        n = len(codes)
        shared, value = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF)), self.codes
        owner, reach = groups, np.arange(1, n + 1)
        # from the leaves up: (mask, value, first child, number of children, end of members)
        levels = []
        first = np.arange(n)
        count = np.ones(n, dtype=np.int64)
        while True:
            begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            levels.append([shared, value, first, count, reach])
            if len(begin) == len(owner):
                break
            within = np.arange(len(owner)) - np.repeat(begin, np.diff(np.append(begin, len(owner))))
            first = np.flatnonzero(within % FAN == 0)
            count = np.diff(np.append(first, len(owner)))
            low = np.bitwise_and.reduceat(value | ~shared, first)
            high = np.bitwise_or.reduceat(value & shared, first)
            common = np.bitwise_and.reduceat(shared, first) & ~(low ^ high)
            # bits known below and equal there are shared above
            shared, value = common, low & common
            owner, reach = owner[first], reach[first + count - 1]
        self.levels = levels
        # leave to each node the bits its parent lacks
        for below, above in zip(levels, levels[1:]):
            parent = np.repeat(np.arange(len(above[2])), above[3])
            below[0] = below[0] & ~above[0][parent]
        self.top = np.searchsorted(levels[-1][4], np.arange(n), side="right")

    def near(self, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (i, j), i before j in ``order``, of one group that differ in at most ``limit``
        bits, as positions in the input, in batches."""
        for begin in range(0, len(self.codes), TOGETHER):
            query = np.arange(begin, min(begin + TOGETHER, len(self.codes)))
            node = self.top[query]
            far = np.zeros(len(query), dtype=np.int64)
            for depth in range(len(self.levels) - 1, -1, -1):
                mask, value, first, count, reach = self.levels[depth]
                far = far + np.bitwise_count((self.codes[query] ^ value[node]) & mask[node])
                stay = (far <= limit) & (reach[node] > query + 1)
                query, node, far = query[stay], node[stay], far[stay]
                if depth == 0:
                    break
                fan = count[node]
                offset = np.arange(int(fan.sum())) - np.repeat(np.cumsum(fan) - fan, fan)
                node = np.repeat(first[node], fan) + offset
                query, far = np.repeat(query, fan), np.repeat(far, fan)
            if len(query):
                yield self.order[query], self.order[node]


def components(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The smallest reachable number of each of 0..n-1."""
    label = np.arange(n)
    while len(left):
        a, b = label[left], label[right]
        low = np.minimum(a, b)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        while True:
            jump = label[label]
            if (jump == label).all():
                break
            label = jump
        open_ = label[left] != label[right]
        left, right = left[open_], right[open_]
    return label
