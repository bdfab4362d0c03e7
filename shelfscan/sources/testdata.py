"""Sales lines in the shape of the fact table, taken from the order tables.

Only the joins that the requested columns need are planned: each of the five keys finds
exactly one row, so leaving a join out changes no row.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.functions.text import product_family
from shelfscan.functions.variant import point
from shelfscan.schemas import KEY, LANDING_KEYS, SALES

AS_OF = date(2001, 8, 15)

# Category names by part number modulo their count.
CATEGORY_NAMES: list[str | None] = [
    "STRAIGHT BOURBON WHISKIES", "CANADIAN WHISKIES", "STRAIGHT RYE WHISKIES",
    "SCOTCH WHISKIES", "AMERICAN BRANDIES", "AMERICAN VODKAS", "IMPORTED GRAPE WINE",
    "FLAVORED GIN", "CREAM LIQUEURS", "TRIPLE SEC", "100% AGAVE TEQUILA",
    "AMERICAN SCHNAPPS", "GOLD RUM", "MEZCAL", "HIGH PROOF BEER", "SPARKLING ROSE",
    "SAKE", "ABSINTHE", "BITTERS", "DRY VERMOUTH", "COCKTAILS/RTD",
    "NEUTRAL GRAIN SPIRITS", "TEMPORARY & SPECIALTY PACKAGES", "WHISKEY LIQUEUR",
    "IMPORTED BRANDY", "GINGER BEER", "DELISTED ITEMS", None,
]

# Store number, longitude, latitude of wrongly located test stores.
CORRECTIONS = [(5, -95.5, 43.5), (7, -91.25, 42.25), (10, -92.75, 43.125)]

LITERS_PER_GALLON = 3.785411784

_ORDERS = {"sale_date", "sale_year", "sale_month"}
_PART = {"vendor_number", "vendor_name", "item_description", "pack",
         "state_bottle_cost", "state_bottle_retail"}
_SUPPLIER = {"store_name"}
_NATION = {"city", "county_number", "county"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _store() -> Column:
    return F.col("l_suppkey").cast("int")


def _day() -> Column:
    return F.col("o_orderdate").cast("date")


def _slot() -> Column:
    return F.pmod(F.col("l_partkey"), F.lit(len(CATEGORY_NAMES))).cast("int")


def _category_name() -> Column:
    return F.get(F.array(*[F.lit(name).cast("string") for name in CATEGORY_NAMES]), _slot())


def _volume() -> Column:
    sizes = F.array(*[F.lit(size) for size in (50, 375, 750, 1750)])
    return F.get(sizes, F.pmod(F.col("l_partkey"), F.lit(4)).cast("int"))


def _liters() -> Column:
    return F.col("l_quantity") * _volume() / F.lit(1000.0)


def _location() -> Column:
    store, located = _store(), _store() % 10 != 0
    return point(
        F.when(located, -((store % 6 + 90) * 10 + store % 10) / 10),
        F.when(located, ((store % 4 + 40) * 10 + store % 9 + 1) / 10))


def _location_json() -> Column:
    return F.when(_store() % 10 != 0, F.expr("""
        concat('{"type":"Point","coordinates":[-', 90 + l_suppkey % 6, '.', l_suppkey % 10, ',',
               40 + l_suppkey % 4, '.', l_suppkey % 9 + 1, ']}')"""))


# column -> expression; made only for the columns a query asks for
_EXPRESSIONS: dict[str, Callable[[], Column]] = {
    KEY: lambda: F.concat(
        F.lit("INV-"), F.lpad(F.col("l_orderkey").cast("string"), 8, "0"),
        F.lpad(F.col("l_linenumber").cast("string"), 3, "0")),
    "sale_date": _day,
    "sale_year": lambda: F.year(_day()),
    "sale_month": lambda: F.month(_day()),
    "store_number": _store,
    "store_name": lambda: F.col("s_name"),
    "address": lambda: F.concat(F.col("l_suppkey").cast("string"), F.lit(" MAIN ST")),
    "city": lambda: F.col("n_name"),
    "zip_code": lambda: (F.col("l_suppkey") + 50000).cast("string"),
    "store_location": _location,
    "store_location_json": _location_json,
    "county_number": lambda: F.col("n_nationkey").cast("int"),
    "county": lambda: F.col("n_name"),
    "category": lambda: _slot() * 100 + 1000000,
    "category_name": _category_name,
    "liquor_category": lambda: product_family(_category_name()),
    "vendor_number": lambda: F.substring("p_brand", 7, 10).cast("int"),
    "vendor_name": lambda: F.col("p_brand"),
    "item_number": lambda: F.col("l_partkey").cast("int"),
    "item_description": lambda: F.expr("if(l_partkey % 2 = 0, upper(p_name), p_name)"),
    "pack": lambda: F.col("p_size").cast("int"),
    "bottle_volume_ml": lambda: _volume().cast("int"),
    "state_bottle_cost": lambda: F.when(F.col("l_linenumber") != 7, F.col("p_retailprice")),
    "state_bottle_retail": lambda: F.col("p_retailprice") * 1.5,
    "bottles_sold": lambda: F.col("l_quantity").cast("int"),
    "sale_dollars": lambda: F.col("l_extendedprice"),
    "volume_sold_liters": _liters,
    "volume_sold_gallons": lambda: _liters() / F.lit(LITERS_PER_GALLON),
}


def sales(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Sales lines with the given columns (default: the whole fact schema)."""
    wanted = list(columns) or SALES.fieldNames()
    need = set(wanted)
    lines = table(spark, sf_dir, "lineitem")
    if need & _ORDERS:
        orders = table(spark, sf_dir, "orders")
        lines = lines.join(orders, lines.l_orderkey == orders.o_orderkey)
    if need & _PART:
        part = table(spark, sf_dir, "part")
        lines = lines.join(part, lines.l_partkey == part.p_partkey)
    if need & (_SUPPLIER | _NATION):
        supplier = table(spark, sf_dir, "supplier")
        lines = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
    if need & _NATION:
        nation = table(spark, sf_dir, "nation")
        lines = lines.join(nation, F.col("s_nationkey") == nation.n_nationkey)
    return lines.select(*[_EXPRESSIONS[name]().alias(name) for name in wanted])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as landing documents: the text fields of a document, nothing typed."""
    source = {
        "invoice_line_no": KEY, "store": "store_number", "name": "store_name",
        "zipcode": "zip_code", "store_location": "store_location_json",
        "vendor_no": "vendor_number", "itemno": "item_number", "im_desc": "item_description",
        "sale_bottles": "bottles_sold", "sale_liters": "volume_sold_liters",
        "sale_gallons": "volume_sold_gallons",
    }
    columns = {key: source.get(key, key) for key in LANDING_KEYS if key != "date"}
    lines = sales(spark, sf_dir, "sale_date", *columns.values())
    stamp = F.concat(F.date_format("sale_date", "yyyy-MM-dd"), F.lit("T00:00:00.000"))
    return lines.select(*[
        (stamp if key == "date" else F.col(columns[key]).cast("string")).alias(key)
        for key in LANDING_KEYS
    ])
