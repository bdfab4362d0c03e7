"""Column lists and schemas of the stored relations."""

from __future__ import annotations

from pyspark.sql import types as T

KEY = "invoice_and_item_number"

# The keys of a landing document.
LANDING_KEYS = [
    "invoice_line_no", "date", "store", "name", "address", "city", "zipcode",
    "store_location", "county_number", "county", "category", "category_name",
    "vendor_no", "vendor_name", "itemno", "im_desc", "pack", "bottle_volume_ml",
    "state_bottle_cost", "state_bottle_retail", "sale_bottles", "sale_dollars",
    "sale_liters", "sale_gallons",
]

RAW = T.StructType([
    T.StructField("raw", T.VariantType()),
    T.StructField("file_name", T.StringType()),
    T.StructField("load_ts", T.TimestampNTZType()),
])

SALES = T.StructType([
    T.StructField(KEY, T.StringType()),
    T.StructField("sale_date", T.DateType()),
    T.StructField("sale_year", T.IntegerType()),
    T.StructField("sale_month", T.IntegerType()),
    T.StructField("store_number", T.IntegerType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("address", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("zip_code", T.StringType()),
    T.StructField("store_location", T.VariantType()),
    T.StructField("county_number", T.IntegerType()),
    T.StructField("county", T.StringType()),
    T.StructField("category", T.IntegerType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("liquor_category", T.StringType()),
    T.StructField("vendor_number", T.IntegerType()),
    T.StructField("vendor_name", T.StringType()),
    T.StructField("item_number", T.IntegerType()),
    T.StructField("item_description", T.StringType()),
    T.StructField("pack", T.IntegerType()),
    T.StructField("bottle_volume_ml", T.IntegerType()),
    T.StructField("state_bottle_cost", T.DoubleType()),
    T.StructField("state_bottle_retail", T.DoubleType()),
    T.StructField("bottles_sold", T.IntegerType()),
    T.StructField("sale_dollars", T.DoubleType()),
    T.StructField("volume_sold_liters", T.DoubleType()),
    T.StructField("volume_sold_gallons", T.DoubleType()),
])

SALES_COLUMNS = SALES.fieldNames()

CALENDAR = T.StructType([
    T.StructField("datekey", T.IntegerType()),
    T.StructField("date", T.DateType()),
    T.StructField("dayofweek", T.StringType()),
    T.StructField("dayofweek_short", T.StringType()),
    T.StructField("month", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("yearmonthnum", T.IntegerType()),
    T.StructField("monthyear", T.StringType()),
    T.StructField("daynuminweek", T.IntegerType()),
    T.StructField("daynuminmonth", T.IntegerType()),
    T.StructField("daynuminyear", T.IntegerType()),
    T.StructField("monthnuminyear", T.IntegerType()),
    T.StructField("iso_year", T.IntegerType()),
    T.StructField("iso_weeknuminyear", T.IntegerType()),
    T.StructField("is_last_day_in_week", T.BooleanType()),
    T.StructField("is_last_day_in_month", T.BooleanType()),
    T.StructField("is_holiday", T.BooleanType()),
    T.StructField("is_weekday", T.BooleanType()),
    T.StructField("is_holiday_us", T.BooleanType()),
    T.StructField("holiday_name_us", T.StringType()),
])

STORES = T.StructType([
    T.StructField("store_number", T.IntegerType()),
    T.StructField("store_name", T.StringType()),
    T.StructField("store_street_address", T.StringType()),
    T.StructField("store_city", T.StringType()),
    T.StructField("store_state", T.StringType()),
    T.StructField("store_zip", T.StringType()),
    T.StructField("store_county", T.StringType()),
    T.StructField("store_county_number", T.IntegerType()),
    T.StructField("corrected_tf", T.BooleanType()),
    T.StructField("store_location", T.VariantType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("latitude", T.DoubleType()),
])

FILE_LEDGER = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("length", T.LongType()),
    T.StructField("modification_time", T.TimestampType()),
])
