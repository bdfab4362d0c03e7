"""Packing of token pieces into windows by multiway differencing.

Documents are cut into full windows and a remainder, remainders into three shrinking pieces. The
pieces of a block (hashed, about ``BLOCK_WINDOWS`` windows of tokens) are dealt to windows by
Karmarkar-Karp differencing: the two partial partitions with the largest imbalance are merged,
full ends against empty ends, until one is left. If a window exceeds the capacity the block is
dealt again over more windows.
"""

from __future__ import annotations

from bisect import insort
import heapq
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import arrow_pass, stored
from shelfscan.llm.tokens import encode_ids

BLOCK_WINDOWS = 384
#: Ids of sequences of one full piece begin here.
FULL_IDS = 1 << 62
#: Windows up to this many are put in their places one by one.
FEW = 16
END_ID = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PACKED = PIECES + ", sequence_id long, offset long"


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of n tokens."""
    whole = n - n % capacity
    found = [(at, capacity) for at in range(0, whole, capacity)]
    at, rest = whole, n - whole
    for share in (2, 2, 1):
        size = rest // share if rest >= 16 else rest
        if size:
            found.append((at, size))
            at, rest = at + size, rest - size
    return found


def differencing(sizes: np.ndarray, windows: int) -> tuple[np.ndarray, int]:
    """The window of each size, and the fullest window's sum.

    A partial partition is its filled windows, smallest first. Two that fit side by side are only
    laid together, as the large ends of one meet the empty ends of the other; else the few large
    ends of the second are added to the small ends of the first.
    """
    n = len(sizes)
    # node i < n is a piece; a node from n on has two children
    children: list[tuple[int, int]] = []
    heap = [(-size, i, [(size, i)]) for i, size in enumerate(sizes.tolist())]
    heapq.heapify(heap)
    tick = n
    while len(heap) > 1:
        one, two = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        if len(one) < len(two):
            one, two = two, one
        if len(one) + len(two) <= windows:
            one = two + one if two[-1] <= one[0] else sorted(one + two)
        else:
            # empty ends first
            one = [(0, -1)] * (windows - len(one)) + one
            met = []
            for (sum_a, node_a), (sum_b, node_b) in zip(one, reversed(two)):
                if node_a >= 0:
                    children.append((node_a, node_b))
                    node_b = n + len(children) - 1
                met.append((sum_a + sum_b, node_b))
            one = one[len(two):]
            if len(met) > FEW:
                one = sorted(one + met)
            else:
                for entry in met:
                    insort(one, entry)
        spread = one[-1][0] - (one[0][0] if len(one) == windows else 0)
        heapq.heappush(heap, (-spread, tick, one))
        tick += 1
    last = heap[0][2]
    window = np.full(n + len(children), -1, dtype=np.int64)
    window[[node for _, node in last]] = np.arange(len(last))
    window = window.tolist()
    for node in range(len(children) - 1, -1, -1):
        left, right = children[node]
        window[left] = window[right] = window[n + node]
    return np.array(window[:n], dtype=np.int64), last[-1][0]


def pack_block(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window and offset of each piece, gapless from 0 in every window."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    window, most = differencing(sizes, windows)
    while most > capacity:
        windows += 1
        window, most = differencing(sizes, windows)
    order = np.argsort(window, kind="stable")
    ends = np.cumsum(sizes[order])
    begins = ends - sizes[order]
    first = np.flatnonzero(np.diff(window[order], prepend=-1))
    base = np.repeat(begins[first], np.diff(np.append(first, len(order))))
    offset = np.empty(len(sizes), dtype=np.int64)
    offset[order] = begins - base
    return window, offset


def token_pieces(docs: DataFrame, path: str, capacity: int, end_id: int = END_ID) -> DataFrame:
    end = int(end_id).to_bytes(4, "little")

    def make():
        def step(columns):
            rows = []
            for doc_id, ids in zip(columns[0], encode_ids(path, columns[1])):
                ids += end
                n = len(ids) // 4
                rows.extend((doc_id, at, size, zlib.crc32(ids[4 * at:4 * (at + size)]), n)
                            for at, size in cuts(n, capacity))
            return list(zip(*rows)) if rows else [[]] * 5

        return step

    return arrow_pass(docs.select("doc_id", "text"), PIECES, make)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024) -> DataFrame:
    """One row per piece with its sequence and its place there.

    Null text is an empty document: its end id alone. Null ids, repeated rows and clashing extra
    columns do no harm, since pieces are dealt to blocks by their place in the written table. A piece
    that fills a window is a sequence by itself, outside all blocks, so a long text brings a block
    three pieces at most. An empty table gives an empty table. Sequences hold at most ``capacity``
    ids.
    """
    pieces = stored(token_pieces(docs, path, capacity), "pieces").withColumn(
        "place", F.monotonically_increasing_id())
    part = pieces.where(F.col("length") < capacity)
    tokens = part.agg(F.sum("length")).first()[0] or 0
    blocks = max(1, round(tokens / (BLOCK_WINDOWS * capacity)))

    def pack(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["length", "doc_id", "start", "ids_crc32"],
                                  ascending=[False, True, True, True], ignore_index=True)
        window, offset = pack_block(block["length"].to_numpy(), capacity)
        block["sequence_id"] = block["block"].to_numpy().astype(np.int64) * (1 << 32) + window
        block["offset"] = offset
        return block[[field.split()[0] for field in PACKED.split(", ")]]

    keyed = part.withColumn("block", F.pmod(F.xxhash64("place"), F.lit(blocks)).cast("int"))
    full = pieces.where(F.col("length") == capacity).withColumns({
        "sequence_id": F.col("place") + F.lit(FULL_IDS), "offset": F.lit(0).cast("long")})
    return keyed.drop("place").groupBy("block").applyInPandas(pack, PACKED).union(
        full.drop("place"))
