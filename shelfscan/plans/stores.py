"""Store dimension: the latest located row of each store, with corrected points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.functions.variant import latitude_of, longitude_of, point
from shelfscan.operators.keyed import first_per_key
from shelfscan.schemas import KEY

STATE = "IA"

# Store number, longitude and latitude of stores the source locates wrongly.
CORRECTIONS = [
    (10505, -95.14875, 43.18232),
    (10129, -91.6823925, 42.2899905),
    (10663, -92.67254, 43.07529),
]

SOURCE_COLUMNS = [
    "store_number", "store_name", "address", "city", "zip_code", "county",
    "county_number", "store_location", "sale_date", KEY,
]


def latest_per_store(sales: DataFrame) -> DataFrame:
    """One row per store: located rows first, then the newest sale date (unknown dates lead).

    The invoice key breaks ties, and the plain columns do where it is missing.
    """
    located_first = F.when(F.col("store_location").isNotNull(), 0).otherwise(1)
    ties = [name for name in SOURCE_COLUMNS
            if name not in ("store_number", "sale_date", "store_location", KEY)]
    return first_per_key(sales.select(*SOURCE_COLUMNS), ["store_number"], [
        located_first, F.col("sale_date").desc_nulls_first(), F.col(KEY), *map(F.col, ties)])


Corrections = Sequence[tuple[int, float, float]] | DataFrame


def corrections_frame(spark: SparkSession, listed: Corrections) -> DataFrame:
    """Corrections as a relation; they may come as a list or as a DataFrame of three columns."""
    names = ["corrected_store", "corrected_longitude", "corrected_latitude"]
    if isinstance(listed, DataFrame):
        return listed.toDF(*names)
    schema = ", ".join(f"{name} {kind}" for name, kind in zip(names, ("int", "double", "double")))
    return spark.createDataFrame(list(listed), schema)


def override_known_bad(stores: DataFrame, listed: Corrections = CORRECTIONS) -> DataFrame:
    """Replace location and coordinates of the listed stores and flag them.

    Both sides have one row per store. Spark broadcasts the corrections when they are small.
    """
    fixes = corrections_frame(stores.sparkSession, listed)
    joined = stores.join(fixes, F.col("store_number") == F.col("corrected_store"), "left")
    fixed_point = point(F.col("corrected_longitude"), F.col("corrected_latitude"))
    return joined.select(
        *[name for name in stores.columns if name != "store_location"],
        F.col("corrected_store").isNotNull().alias("corrected_tf"),
        F.coalesce(fixed_point, F.col("store_location")).alias("store_location"),
        F.coalesce("corrected_longitude", longitude_of(F.col("store_location"))).alias("longitude"),
        F.coalesce("corrected_latitude", latitude_of(F.col("store_location"))).alias("latitude"),
    )


def store_locations(
    sales: DataFrame,
    corrections: Corrections = CORRECTIONS,
    state: str = STATE,
    keep_unlocated: bool = False,
) -> DataFrame:
    """The store dimension.

    A store without any location in the source is left out even when a correction lists
    it; ``keep_unlocated`` keeps every store instead.
    """
    latest = latest_per_store(sales)
    if not keep_unlocated:
        latest = latest.where(F.col("store_location").isNotNull())
    return override_known_bad(latest, corrections).select(
        "store_number", "store_name", F.col("address").alias("store_street_address"),
        F.col("city").alias("store_city"), F.lit(state).alias("store_state"),
        F.col("zip_code").alias("store_zip"), F.col("county").alias("store_county"),
        F.col("county_number").alias("store_county_number"),
        "corrected_tf", "store_location", "longitude", "latitude",
    )
