"""CSV files with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfscan.functions.variant import json_or_scalar
from shelfscan.schemas import CALENDAR, SALES


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multi_line: bool = False) -> DataFrame:
    """Headed CSV read by position into a schema; records that do not fit are skipped.

    The reader only notices a bad value in a column it has to read, so the always-true
    condition on all columns makes a record good or bad whatever columns a query asks for.
    """
    rows = (
        spark.read.schema(schema)
        .option("header", True).option("enforceSchema", True)
        .option("quote", '"').option("escape", '"')
        .option("multiLine", multi_line).option("mode", "DROPMALFORMED")
        .csv(path)
    )
    return rows.where(F.hash(*schema.fieldNames()).bitwiseOR(F.lit(1)) != 0)


def read_calendar_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, CALENDAR)


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """Sales lines from CSV, whose location field holds JSON over several lines."""
    as_text = T.StructType([
        T.StructField(f.name, T.StringType() if f.dataType == T.VariantType() else f.dataType)
        for f in SALES.fields
    ])
    rows = read_csv(spark, path, as_text, multi_line=True)
    return rows.withColumn("store_location", json_or_scalar(F.col("store_location")))
