"""Helpers for semi-structured columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_at(document: Column, key: str) -> Column:
    """The value under a top-level key as text; NULL when missing or JSON null."""
    return F.try_variant_get(document, f"$.{key}", "string")


def json_or_scalar(text: Column) -> Column:
    """Text parsed as JSON, or kept as a scalar variant when it is not JSON.

    JSON null becomes SQL NULL, so that ``IS NOT NULL`` means "has a value".
    """
    value = F.coalesce(F.try_parse_json(text), text.cast("variant"))
    return F.when(F.trim(text) != "null", value)


def point(longitude: Column, latitude: Column) -> Column:
    """A GeoJSON point as a variant; NULL unless both coordinates are known."""
    shape = F.to_variant_object(F.struct(
        F.lit("Point").alias("type"),
        F.array(longitude, latitude).alias("coordinates"),
    ))
    return F.when(longitude.isNotNull() & latitude.isNotNull(), shape)


def longitude_of(location: Column) -> Column:
    return F.try_variant_get(location, "$.coordinates[0]", "double")


def latitude_of(location: Column) -> Column:
    return F.try_variant_get(location, "$.coordinates[1]", "double")
