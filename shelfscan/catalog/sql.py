"""SQL fragments of the reference answers, for an independent engine on the same tables."""

from __future__ import annotations

from shelfscan.functions.text import FAMILY_RULES, OTHER_FAMILY
from shelfscan.sources.testdata import CATEGORY_NAMES, CORRECTIONS, LITERS_PER_GALLON


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _family_case(column: str) -> str:
    branches = [
        "WHEN " + " OR ".join(f"lower({column}) LIKE '%{word}%'" for word in words)
        + f" THEN {_text(label)}" for words, label in FAMILY_RULES
    ]
    return "CASE " + " ".join(branches) + f" ELSE {_text(OTHER_FAMILY)} END"


_CATEGORIES = ", ".join(
    f"({number}, {_text(name)})" for number, name in enumerate(CATEGORY_NAMES))

SALES = f"""
categories(idx, category_name) AS (VALUES {_CATEGORIES}),
lines AS (
  SELECT l.*, o.o_orderdate, p.p_name, p.p_brand, p.p_size, p.p_retailprice,
         s.s_name, n.n_nationkey, n.n_name, c.category_name, c.idx,
         CASE l.l_partkey % 4 WHEN 0 THEN 50 WHEN 1 THEN 375 WHEN 2 THEN 750 ELSE 1750 END AS ml
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN categories c ON c.idx = l.l_partkey % {len(CATEGORY_NAMES)}
),
sales AS (
  SELECT
    'INV-' || lpad(CAST(l_orderkey AS VARCHAR), 8, '0')
           || lpad(CAST(l_linenumber AS VARCHAR), 3, '0') AS invoice_and_item_number,
    CAST(o_orderdate AS DATE) AS sale_date,
    CAST(year(o_orderdate) AS INTEGER) AS sale_year,
    CAST(month(o_orderdate) AS INTEGER) AS sale_month,
    CAST(l_suppkey AS INTEGER) AS store_number,
    s_name AS store_name,
    CAST(l_suppkey AS VARCHAR) || ' MAIN ST' AS address,
    n_name AS city,
    CAST(50000 + l_suppkey AS VARCHAR) AS zip_code,
    CASE WHEN l_suppkey % 10 <> 0 THEN
      CAST('-' || (90 + l_suppkey % 6) || '.' || (l_suppkey % 10) AS DOUBLE) END AS longitude,
    CASE WHEN l_suppkey % 10 <> 0 THEN
      CAST((40 + l_suppkey % 4) || '.' || (l_suppkey % 9 + 1) AS DOUBLE) END AS latitude,
    CAST(n_nationkey AS INTEGER) AS county_number,
    n_name AS county,
    CAST(1000000 + 100 * idx AS INTEGER) AS category,
    category_name,
    {_family_case('category_name')} AS liquor_category,
    CAST(substr(p_brand, 7) AS INTEGER) AS vendor_number,
    p_brand AS vendor_name,
    CAST(l_partkey AS INTEGER) AS item_number,
    CASE WHEN l_partkey % 2 = 0 THEN upper(p_name) ELSE p_name END AS item_description,
    CAST(p_size AS INTEGER) AS pack,
    CAST(ml AS INTEGER) AS bottle_volume_ml,
    CASE WHEN l_linenumber <> 7 THEN p_retailprice END AS state_bottle_cost,
    p_retailprice * 1.5::DOUBLE AS state_bottle_retail,
    CAST(l_quantity AS INTEGER) AS bottles_sold,
    l_extendedprice AS sale_dollars,
    l_quantity * ml / 1000.0::DOUBLE AS volume_sold_liters,
    l_quantity * ml / 1000.0::DOUBLE / {LITERS_PER_GALLON}::DOUBLE AS volume_sold_gallons
  FROM lines
)"""

# one row per key: the smallest row in column order
DEDUP = """
unique_sales AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY invoice_and_item_number ORDER BY
      sale_date NULLS FIRST, store_number NULLS FIRST, category NULLS FIRST,
      vendor_number NULLS FIRST, vendor_name NULLS FIRST, item_number NULLS FIRST,
      item_description NULLS FIRST, pack NULLS FIRST, bottle_volume_ml NULLS FIRST,
      state_bottle_cost NULLS FIRST, state_bottle_retail NULLS FIRST,
      bottles_sold NULLS FIRST, sale_dollars NULLS FIRST) AS place
    FROM sales)
  WHERE place = 1
)"""

TTM = """
bounds AS (
  SELECT CAST(date_trunc('month', max(sale_date)) - INTERVAL 11 MONTH AS DATE) AS low,
         CAST(date_trunc('month', max(sale_date)) + INTERVAL 1 MONTH AS DATE) AS high
  FROM sales
),
ttm AS (
  SELECT sales.* FROM sales, bounds WHERE sale_date >= low AND sale_date < high
)"""

STORES = f"""
fixes(store, fixed_longitude, fixed_latitude) AS (VALUES {", ".join(map(str, CORRECTIONS))}),
latest_store AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY store_number ORDER BY
      CASE WHEN longitude IS NOT NULL THEN 0 ELSE 1 END, sale_date DESC NULLS FIRST) AS place
    FROM sales)
  WHERE place = 1
),
stores AS (
  SELECT store_number, store_name, address AS store_street_address, city AS store_city,
         'IA' AS store_state, zip_code AS store_zip, county AS store_county,
         county_number AS store_county_number, store IS NOT NULL AS corrected_tf,
         coalesce(fixed_longitude, longitude) AS longitude,
         coalesce(fixed_latitude, latitude) AS latitude
  FROM latest_store LEFT JOIN fixes ON store_number = store
  WHERE longitude IS NOT NULL
)"""

MONTHLY = """
monthly AS (
  SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month,
         sum(CAST(sale_dollars AS DECIMAL(38,10))) AS total
  FROM sales GROUP BY 1
)"""

DAILY = """
daily AS (
  SELECT sale_date, sum(CAST(sale_dollars AS DECIMAL(38,10))) AS total FROM sales GROUP BY 1
)"""


def with_sales(*parts: str, select: str) -> str:
    """A statement over the sales lines and further common table expressions."""
    return "WITH " + ",\n".join([SALES.strip(), *[part.strip() for part in parts]]) + "\n" + select.strip()


def money(column: str = "sale_dollars") -> str:
    """Exact sum of a money column."""
    return f"sum(CAST({column} AS DECIMAL(38,10)))"


def whole(value: str) -> str:
    return f"CAST(round({value}, 0) AS DOUBLE)"


def title(column: str) -> str:
    """Title case of words parted by blanks; the names hold no other word breaks."""
    return (f"list_aggregate([upper(w[1]) || w[2:] for w in string_split(lower({column}), ' ')], "
            "'string_agg', ' ')")


def share(numerator: str, denominator: str) -> str:
    return (f"round(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0.0), 6)")


MARGIN = "CAST(sale_dollars - state_bottle_cost * bottles_sold AS DECIMAL(38,10))"
COST = "CAST(state_bottle_cost * bottles_sold AS DECIMAL(38,10))"


def part_in(value: str, low: str, high: str) -> str:
    """Exact sum of a line value over a half-open period."""
    return (f"coalesce(sum(CASE WHEN sale_date >= {low} AND sale_date < {high} "
            f"THEN {value} END), 0)")


SALE = "CAST(sale_dollars AS DECIMAL(38,10))"
