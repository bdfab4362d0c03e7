"""Connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscan.llm.common import stored


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a != b"))


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where("a != b").union(low.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``a, b`` per node with a smaller one in its component; b is the smallest.

    ``edges`` has the numeric columns ``a, b``. Each round is written to the shared folder. A round
    that changes nothing ends it; the number of rounds grows with the logarithm of the size.
    """
    now = stored(edges.where("a != b").distinct(), "links")
    before = None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")),
                        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return now
        before = state
        now = stored(small_star(large_star(now)), "links")
