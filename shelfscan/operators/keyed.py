"""Choosing one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.schemas import KEY
from shelfscan.session import fresh_folder, removed, slices_by_key, written_in_slices


def sortable(rows: DataFrame, names: Sequence[str]) -> list[Column]:
    """The columns in a form that can be ordered; variants are ordered by their JSON text."""
    kinds = {field.name: field.dataType for field in rows.schema.fields}
    return [
        F.to_json(F.col(name)) if isinstance(kinds[name], T.VariantType) else F.col(name)
        for name in names
    ]


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark plans a group limit ahead of the shuffle, so every task sends at most one row per
    key and a key that holds much of the data does not land in one task.
    """
    place = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_place", F.row_number().over(place)).where("_place = 1").drop("_place")


def dedup_by_key(
    rows: DataFrame, key: str = KEY, prefer: Sequence[Column] = (), drop: Sequence[str] = (),
) -> DataFrame:
    """One row per key; rows without a key count as one group, as in DROP DUPLICATES.

    ``prefer`` orders the copies of a key; all columns break ties, so the survivor does not
    depend on partitioning or retries.
    """
    rest = [name for name in rows.columns if name != key]
    kept = first_per_key(rows, [key], [*prefer, *sortable(rows, rest)])
    return kept.drop(*drop)


def unique_by_key(
    rows: DataFrame, key: str = KEY, prefer: Sequence[Column] = (), drop: Sequence[str] = (),
) -> DataFrame:
    """:func:`dedup_by_key`, written to the shared folder: for rows that are read more than once.

    The rows are written first, which ends the shuffles they come from, and then taken in slices of
    their keys.
    """
    spark = rows.sparkSession
    source = fresh_folder(spark, "rows")
    try:
        stored = written_in_slices([rows], source)
        slices = slices_by_key(F.col(key), stored.count())
        return written_in_slices(
            [dedup_by_key(stored.where(part), key, prefer, drop) for part in slices],
            fresh_folder(spark, "unique"))
    finally:
        removed(spark, source)
