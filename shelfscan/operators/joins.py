"""Joins of the fact with its dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_dimension(
    fact: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, how: str = "inner",
) -> DataFrame:
    """Row-level join with a dimension that has a unique key; ``how`` is inner or left.

    Nothing is counted or kept while the plan is made. Spark broadcasts a dimension whose bytes it
    knows to be few, as those of a saved one, or finds to be few when it has run; otherwise both
    sides are shuffled, and adaptive execution splits the partitions of hot or missing keys, since
    the fact is the side whose rows all stay.
    """
    renamed = dimension.withColumnRenamed(dimension_key, "_key")
    return fact.join(renamed, fact[fact_key] == renamed["_key"], how).drop("_key")


def join_totals(
    totals: DataFrame, dimension: DataFrame, fact_key: str, dimension_key: str, how: str,
) -> DataFrame:
    """Join of totals that were grouped by the key beforehand.

    Grouping first leaves few rows per key however many fact rows it had, so a plain join
    is enough; Spark decides on broadcast from measured sizes.
    """
    renamed = dimension.withColumnRenamed(dimension_key, "_key")
    return totals.join(renamed, totals[fact_key] == renamed["_key"], how).drop("_key")
