"""Every operator and report as a query over the given tables, with its reference SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.catalog import sql as q
from shelfscan.catalog import staged
from shelfscan.functions import dates, numbers, text, variant
from shelfscan.operators import filters, keyed, metrics, rolling, transform, upsert
from shelfscan.operators.months import MonthTable
from shelfscan.plans import (
    calendar, checks, loads, questions, reports, schedule, semantic, stores, verified,
)
from shelfscan.schemas import KEY, LANDING_KEYS, SALES
from shelfscan.session import TABLE_CODEC, TEXT_CODEC, fresh_folder, shuffles_released
from shelfscan.sources import csvfiles, landing
from shelfscan.sources.testdata import AS_OF, CORRECTIONS, documents, sales, table
from shelfscan.streaming import feed

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return function
    return add


# Reference SQL: pages of a month, one landing file each.
PAGES = f"""
pages AS (
  SELECT sale_year AS year, sale_month AS month,
         CAST(ceil(count(*) / {landing.PAGE_SIZE}.0) AS BIGINT) AS files, count(*) AS rows
  FROM sales GROUP BY 1, 2
)"""

PLAIN_SALES = [field.name for field in SALES.fields if field.name != "store_location"]


def sum_sales():
    return numbers.total(F.col("sale_dollars")).alias("sales")


# ------------------------------------------------------------ scans, sources, sinks

@register("scan_jsonl_variant", q.with_sales(select="""
SELECT invoice_and_item_number AS invoice_line_no, strftime(sale_date, '%Y-%m-%dT00:00:00.000') AS date,
       CAST(store_number AS VARCHAR) AS store, item_description AS im_desc, sale_dollars
FROM sales"""))
def scan_jsonl_variant(spark, sf_dir):
    raw = landing.scan_documents(spark, staged.landing_folder(spark, sf_dir))
    picked = transform.extract_fields(raw)
    return picked.select("invoice_line_no", "date", "store", "im_desc",
                         F.col("sale_dollars").cast("double").alias("sale_dollars"))


@register("scan_provenance", q.with_sales(PAGES, select="""
SELECT year, month, files, rows, rows AS stamped FROM pages"""))
def scan_provenance(spark, sf_dir):
    raw = landing.scan_documents(spark, staged.landing_folder(spark, sf_dir))
    part = r"year=(\d+)/month=(\d+)/"
    by_file = raw.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("load_ts").alias("stamped"))
    return by_file.groupBy(
        F.regexp_extract("file_name", part, 1).cast("int").alias("year"),
        F.regexp_extract("file_name", part, 2).cast("int").alias("month"),
    ).agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"),
          F.sum("stamped").alias("stamped"))


@register("scan_partition_filter", q.with_sales(select="""
SELECT sale_year AS year, sale_month AS month, count(*) AS rows FROM sales
WHERE (sale_year = 1999 AND sale_month IN (2, 12)) OR (sale_year = 2000 AND sale_month = 2)
GROUP BY 1, 2"""))
def scan_partition_filter(spark, sf_dir):
    lines = landing.scan_lines(
        spark, staged.landing_folder(spark, sf_dir), months=[(1999, 2), (1999, 12), (2000, 2)])
    return lines.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@register("scan_partition_filter_years", q.with_sales(select="""
SELECT sale_year AS year, sale_month AS month, count(*) AS rows FROM sales
WHERE sale_year IN (1997, 2001) GROUP BY 1, 2"""))
def scan_partition_filter_years(spark, sf_dir):
    lines = landing.scan_lines(
        spark, staged.landing_folder(spark, sf_dir), years=[2001, 1997, 2001])
    return lines.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@register("scan_skip_bad_records", """
SELECT 'good' AS kind, count(*) AS rows FROM events
UNION ALL SELECT 'bad', 2 * count(*) FROM events""")
def scan_skip_bad_records(spark, sf_dir):
    # each document once whole, once cut short and once with a repeated key, and blank lines
    folder = fresh_folder(spark, "broken")
    props = F.col("props")
    spoiled = table(spark, sf_dir, "events").select(F.explode(F.array(
        props, F.substring(props, F.lit(1), F.length(props) - 1),
        F.concat(F.lit('{"k": 0, '), F.substring(props, F.lit(2), F.length(props))),
        F.lit("  "))).alias("value"))
    spoiled.write.option("compression", "none").text(folder)
    # Spark names text files .txt
    raw = landing.as_raw(landing.parsed_once(spark.read).option("pathGlobFilter", "*").load(folder))
    return checks.row_counts(
        good=landing.good_documents(raw), bad=landing.bad_documents(raw),
    ).withColumnRenamed("relation", "kind")


@register("load_once_ledger", q.with_sales(PAGES, select="""
SELECT year, month, files FROM pages WHERE year >= 1999"""))
def load_once_ledger(spark, sf_dir):
    files = landing.list_files(spark, staged.landing_folder(spark, sf_dir))
    ledger = files.where(F.col("year") < 1999)
    return landing.not_loaded(files, ledger).groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("files"))


@register("join_anti_ledger", q.with_sales(PAGES, select="""
SELECT year, month, rows FROM pages WHERE year < 1999"""))
def join_anti_ledger(spark, sf_dir):
    folder = staged.landing_folder(spark, sf_dir)
    files = landing.list_files(spark, folder)
    fresh = landing.not_loaded(files, files.where(F.col("year") >= 1999))
    lines = landing.scan_lines(spark, folder).select(
        "year", "month", F.col("_metadata.file_path").alias("file_name"))
    return lines.join(fresh.select("file_name"), "file_name", "left_semi").groupBy(
        "year", "month").agg(F.count(F.lit(1)).alias("rows"))


@register("scan_csv_dim", q.with_sales(select="""
SELECT CAST(d AS DATE) AS date, CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS datekey,
       strftime(d, '%A') AS dayofweek, d = last_day(d) AS is_last_day_in_month
FROM (SELECT unnest(generate_series(make_date(min(sale_year), 1, 1),
             make_date(max(sale_year), 12, 31), INTERVAL 1 DAY)) AS d FROM sales)"""))
def scan_csv_dim(spark, sf_dir):
    folder = fresh_folder(spark, "calendar")
    built = calendar.calendar_of(sales(spark, sf_dir, "sale_date"))
    built.write.option("header", True).option("quoteAll", True).csv(folder)
    return csvfiles.read_calendar_csv(spark, folder).select(
        "date", "datekey", "dayofweek", "is_last_day_in_month")


@register("scan_csv_multiline", q.with_sales(select="""
SELECT invoice_and_item_number, sale_date, item_description, sale_dollars, longitude, latitude
FROM sales"""))
def scan_csv_multiline(spark, sf_dir):
    folder = fresh_folder(spark, "sample")
    # location JSON spread over several lines, its quotes doubled by the writer
    spread = F.regexp_replace("store_location_json", r"([{,\[\]])", "$1\n  ")
    columns = [name if name != "store_location" else "store_location_json"
               for name in SALES.fieldNames()]
    lines = sales(spark, sf_dir, *columns).withColumn("store_location_json", spread)
    with shuffles_released(spark):
        lines.write.option("header", True).option("quote", '"').option("escape", '"').option(
            "compression", TEXT_CODEC).csv(folder)
    read = csvfiles.read_sales_csv(spark, folder)
    location = F.col("store_location")
    return read.select(
        KEY, "sale_date", "item_description", "sale_dollars",
        variant.longitude_of(location).alias("longitude"),
        variant.latitude_of(location).alias("latitude"))


@register("list_files", q.with_sales(PAGES, select="""
SELECT year, month, files, files AS with_content FROM pages"""))
def list_files(spark, sf_dir):
    files = landing.list_files(spark, staged.landing_folder(spark, sf_dir))
    return files.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("files"), F.count_if(F.col("length") > 0).alias("with_content"))


@register("sink_jsonl_partitioned", q.with_sales(select=f"""
SELECT sale_year AS year, sale_month AS month, count(*) AS rows,
       CAST({q.money()} AS DOUBLE) AS sales
FROM sales GROUP BY 1, 2"""))
def sink_jsonl_partitioned(spark, sf_dir):
    schema = ", ".join(f"{key} string" for key in LANDING_KEYS)
    read = spark.read.schema(schema).json(staged.landing_folder(spark, sf_dir))
    return read.groupBy("year", "month").agg(
        F.count(F.lit(1)).alias("rows"),
        numbers.total(F.col("sale_dollars").cast("double")).alias("sales"))


@register("page_assign", q.with_sales(select="""
SELECT invoice_line_no, year, month, row_in_month,
       CAST((row_in_month - 1) // 250 + 1 AS INTEGER) AS page
FROM (SELECT invoice_and_item_number AS invoice_line_no, sale_year AS year, sale_month AS month,
             row_number() OVER (PARTITION BY sale_year, sale_month
               ORDER BY sale_date, md5(invoice_and_item_number), item_number, store_number,
                        sale_dollars) AS row_in_month
      FROM sales)"""))
def page_assign(spark, sf_dir):
    paged = landing.page_assign(documents(spark, sf_dir), "invoice_line_no", page_size=250)
    return paged.select("invoice_line_no", "year", "month", "row_in_month", "page")


@register("sink_raw_append", q.with_sales(select="""
SELECT sale_year AS year, count(*) AS rows FROM sales GROUP BY 1"""))
def sink_raw_append(spark, sf_dir):
    folder = fresh_folder(spark, "raw")
    raw = landing.scan_documents(
        spark, staged.landing_folder(spark, sf_dir), years=range(1990, 1998))
    raw.write.mode("append").option("compression", TABLE_CODEC).parquet(folder)
    raw = landing.scan_documents(
        spark, staged.landing_folder(spark, sf_dir), years=range(1998, 2010))
    raw.write.mode("append").option("compression", TABLE_CODEC).parquet(folder)
    stamp = variant.text_at(F.col("raw"), "date")
    return spark.read.parquet(folder).groupBy(
        F.year(transform.sale_day(stamp)).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


@register("temp_view", q.with_sales(select="""
SELECT liquor_category, count(*) AS rows FROM sales GROUP BY 1"""))
def temp_view(spark, sf_dir):
    name = f"sales_{uuid.uuid4().hex[:8]}"
    sales(spark, sf_dir, "liquor_category").createOrReplaceTempView(name)
    return spark.sql(f"SELECT liquor_category, count(*) AS rows FROM {name} GROUP BY 1")


@register("cache_result", q.with_sales(q.DEDUP, select="""
SELECT (SELECT count(*) FROM unique_sales) AS prepared, sale_year, count(*) AS rows
FROM unique_sales GROUP BY sale_year"""))
def cache_result(spark, sf_dir):
    prepared = keyed.dedup_by_key(sales(spark, sf_dir, KEY, "sale_date", "sale_year")).persist()
    count = prepared.count()
    return prepared.groupBy("sale_year").agg(
        F.lit(count).cast("bigint").alias("prepared"), F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------ projections and types

@register("variant_extract", """
SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS missing FROM events""")
def variant_extract(spark, sf_dir):
    props = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select(
        "event_id", variant.text_at(props, "k").cast("int").alias("k"),
        variant.text_at(props, "absent").alias("missing"))


@register("typed_cast", """
SELECT l_orderkey, l_linenumber, CAST(l_quantity AS INTEGER) AS whole,
       CAST(round(CAST(l_extendedprice AS DECIMAL(38,6)), 0) AS INTEGER) AS rounded,
       l_extendedprice AS price, CAST(NULL AS INTEGER) AS bad
FROM lineitem""")
def typed_cast(spark, sf_dir):
    quantity, price = F.col("l_quantity").cast("string"), F.col("l_extendedprice").cast("string")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.whole_number(quantity).alias("whole"),
        numbers.whole_number(price).alias("rounded"),
        numbers.real_number(price).alias("price"),
        numbers.whole_number(F.concat(F.lit("no. "), quantity), strict=False).alias("bad"))


@register("date_parts", q.with_sales(select="""
SELECT sale_date, sale_year, sale_month, count(*) AS rows FROM sales GROUP BY 1, 2, 3"""))
def date_parts(spark, sf_dir):
    stamp = F.concat(F.date_format("sale_date", "yyyy-MM-dd"), F.lit("T00:00:00.000"))
    day = transform.sale_day(F.col("stamp"))
    return sales(spark, sf_dir, "sale_date").select(stamp.alias("stamp")).groupBy(
        day.alias("sale_date"), F.year(day).alias("sale_year"), F.month(day).alias("sale_month"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@register("json_or_scalar", """
SELECT event_id, 'object' AS form, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS scalar, TRUE AS known FROM events
UNION ALL SELECT event_id, 'text', NULL, event_type, TRUE FROM events
UNION ALL SELECT event_id, 'json null', NULL, NULL, FALSE FROM events
UNION ALL SELECT event_id, 'missing', NULL, NULL, FALSE FROM events""")
def json_or_scalar(spark, sf_dir):
    forms = F.array(*[
        F.struct(F.lit(form).alias("form"), value.cast("string").alias("value"))
        for form, value in [
            ("object", F.col("props")), ("text", F.col("event_type")),
            ("json null", F.lit("null")), ("missing", F.lit(None))]])
    rows = table(spark, sf_dir, "events").select("event_id", F.inline(forms))
    value = variant.json_or_scalar(F.col("value"))
    return rows.select(
        "event_id", "form", F.try_variant_get(value, "$.k", "int").alias("k"),
        F.when(F.col("form") == "text", F.try_variant_get(value, "$", "string")).alias("scalar"),
        value.isNotNull().alias("known"))


@register("rename_project", q.with_sales(select=f"""
SELECT {", ".join(PLAIN_SALES)}, longitude, latitude FROM sales"""))
def rename_project(spark, sf_dir):
    typed = transform.to_sales(
        landing.scan_documents(spark, staged.landing_folder(spark, sf_dir)))
    location = F.col("store_location")
    return typed.select(
        *PLAIN_SALES, variant.longitude_of(location).alias("longitude"),
        variant.latitude_of(location).alias("latitude"))


@register("classify_family", q.with_sales(select="""
SELECT category_name, liquor_category, count(*) AS rows FROM sales GROUP BY 1, 2"""))
def classify_family(spark, sf_dir):
    names = sales(spark, sf_dir, "category_name")
    return names.groupBy(
        "category_name", text.product_family(F.col("category_name")).alias("liquor_category"),
    ).agg(F.count(F.lit(1)).alias("rows"))


def _store_sales(spark, sf_dir):
    return sales(spark, sf_dir, *stores.SOURCE_COLUMNS)


def _store_dim(spark, sf_dir, **options):
    return stores.store_locations(_store_sales(spark, sf_dir), CORRECTIONS, **options)


@register("const_column", q.with_sales(q.STORES, select="""
SELECT store_number, store_state FROM stores"""))
def const_column(spark, sf_dir):
    return _store_dim(spark, sf_dir).select("store_number", "store_state")


@register("override_known_bad", q.with_sales(q.STORES, select="""
SELECT store_number, corrected_tf, longitude, latitude FROM stores"""))
def override_known_bad(spark, sf_dir):
    located = stores.latest_per_store(_store_sales(spark, sf_dir)).where(
        filters.known(F.col("store_location")))
    return stores.override_known_bad(located, CORRECTIONS).select(
        "store_number", "corrected_tf", "longitude", "latitude")


@register("geo_extract", q.with_sales(select="""
SELECT store_number, longitude, latitude, count(*) AS rows FROM sales GROUP BY 1, 2, 3"""))
def geo_extract(spark, sf_dir):
    location = F.col("store_location")
    return sales(spark, sf_dir, "store_number", "store_location").groupBy(
        "store_number", variant.longitude_of(location).alias("longitude"),
        variant.latitude_of(location).alias("latitude"),
    ).agg(F.count(F.lit(1)).alias("rows"))


@register("geo_construct", q.with_sales(select="""
SELECT invoice_and_item_number, CASE WHEN longitude IS NOT NULL THEN 'Point' END AS kind,
       longitude, latitude FROM sales"""))
def geo_construct(spark, sf_dir):
    location = F.col("store_location")
    made = sales(spark, sf_dir, KEY, "store_location").select(KEY, variant.point(
        variant.longitude_of(location), variant.latitude_of(location)).alias("point"))
    return made.select(
        KEY, variant.text_at(F.col("point"), "type").alias("kind"),
        variant.longitude_of(F.col("point")).alias("longitude"),
        variant.latitude_of(F.col("point")).alias("latitude"))


CATEGORY_REPORT = f"""
SELECT {q.title('liquor_category')} AS liquor_category, {q.whole(q.money())} AS ttm_sales
FROM ttm GROUP BY 1 ORDER BY ttm_sales DESC NULLS FIRST, 1"""

ITEM_REPORT = f"""
SELECT {q.title('item_description')} AS item, {q.whole(q.money())} AS ttm_sales
FROM ttm GROUP BY 1 ORDER BY ttm_sales DESC NULLS FIRST, 1"""


@register("alias_quoted", q.with_sales(q.TTM, select=f"""
SELECT liquor_category AS "Liquor Category", ttm_sales AS "TTM Sales" FROM ({CATEGORY_REPORT})"""))
def alias_quoted(spark, sf_dir):
    lines = sales(spark, sf_dir, "sale_date", "sale_dollars", "liquor_category")
    return reports.with_labels(reports.ttm_sales_by_category(lines))


# Reference SQL: monthly report with a one-row parameter relation.
def _monthly_report(months: int, frame: int) -> str:
    return q.with_sales(f"""
params AS (
  SELECT CAST(date_trunc('month', DATE '{AS_OF}') - INTERVAL {months} MONTH AS DATE) AS visible_start,
         CAST(date_trunc('month', DATE '{AS_OF}') AS DATE) AS visible_end
)""", f"""
monthly AS (
  SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month,
         sum(CAST(sale_dollars AS DECIMAL(38,10))) AS total
  FROM sales
  WHERE sale_date >= (SELECT visible_start - INTERVAL {frame - 1} MONTH FROM params)
    AND sale_date < (SELECT visible_end + INTERVAL 1 MONTH FROM params)
  GROUP BY 1
)""", f"""
calc AS (
  SELECT month, total,
         CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w AS mean
  FROM monthly WINDOW w AS (ORDER BY month ROWS BETWEEN {frame - 1} PRECEDING AND CURRENT ROW)
)""", select="""
SELECT month AS sale_date, CAST(round(total, 0) AS DOUBLE) AS monthly_sales,
       round(mean, 0) AS ttm_avg_sales
FROM calc
WHERE month BETWEEN (SELECT visible_start FROM params) AND (SELECT visible_end FROM params)
ORDER BY month""")


@register("params_relation", _monthly_report(18, 6))
def params_relation(spark, sf_dir):
    lines = sales(spark, sf_dir, "sale_date", "sale_dollars")
    return reports.monthly_sales(lines, as_of=AS_OF, months=18, frame=6)


# ------------------------------------------------------------ filters

@register("filter_ttm_window", q.with_sales(q.TTM, select=f"""
SELECT count(*) AS rows, min(sale_date) AS first_day, max(sale_date) AS last_day,
       CAST({q.money()} AS DOUBLE) AS sales FROM ttm"""))
def filter_ttm_window(spark, sf_dir):
    kept = filters.trailing_year(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    return kept.agg(F.count(F.lit(1)).alias("rows"), F.min("sale_date").alias("first_day"),
                    F.max("sale_date").alias("last_day"), sum_sales())


@register("filter_between", q.with_sales(select="""
SELECT sale_date, count(*) AS rows FROM sales
WHERE sale_date BETWEEN DATE '1998-02-01' AND DATE '1998-03-31' GROUP BY 1"""))
def filter_between(spark, sf_dir):
    return sales(spark, sf_dir, "sale_date").where(
        F.col("sale_date").between(F.lit(date(1998, 2, 1)), F.lit(date(1998, 3, 31)))
    ).groupBy("sale_date").agg(F.count(F.lit(1)).alias("rows"))


@register("filter_lookback", q.with_sales(select=f"""
SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, CAST({q.money()} AS DOUBLE) AS sales
FROM sales WHERE sale_date >= DATE '1997-09-01' AND sale_date < DATE '2001-09-01' GROUP BY 1"""))
def filter_lookback(spark, sf_dir):
    end = dates.first_of_month(AS_OF)
    start = dates.shift_months(dates.shift_months(end, -36), -11)
    kept = filters.between_dates(
        sales(spark, sf_dir, "sale_date", "sale_dollars"), start, dates.shift_months(end, 1))
    return kept.groupBy(dates.month_start(F.col("sale_date")).alias("month")).agg(sum_sales())


@register("filter_last_full_month", q.with_sales(select="""
SELECT CAST(date_trunc('month', DATE '2001-08-15') - INTERVAL 1 MONTH AS DATE) AS month_start,
       CAST(date_trunc('month', DATE '2001-08-15') - INTERVAL 1 DAY AS DATE) AS month_end,
       count(*) AS rows
FROM sales
WHERE sale_date BETWEEN date_trunc('month', DATE '2001-08-15') - INTERVAL 1 MONTH
                    AND date_trunc('month', DATE '2001-08-15') - INTERVAL 1 DAY"""))
def filter_last_full_month(spark, sf_dir):
    low, high = dates.last_full_month(AS_OF)
    return sales(spark, sf_dir, "sale_date").where(
        F.col("sale_date").between(F.lit(low), F.lit(high))
    ).agg(F.lit(low).alias("month_start"), F.lit(high).alias("month_end"),
          F.count(F.lit(1)).alias("rows"))


@register("filter_in_list", q.with_sales(select="""
SELECT store_number, count(*) AS rows FROM sales WHERE store_number IN (5, 7, 10) GROUP BY 1"""))
def filter_in_list(spark, sf_dir):
    return filters.in_list(
        sales(spark, sf_dir, "store_number"), "store_number", [5, 7, 10],
    ).groupBy("store_number").agg(F.count(F.lit(1)).alias("rows"))


@register("filter_not_null", q.with_sales(select="""
SELECT store_number, count(*) AS rows FROM sales WHERE longitude IS NOT NULL GROUP BY 1"""))
def filter_not_null(spark, sf_dir):
    return sales(spark, sf_dir, "store_number", "store_location").where(
        filters.known(F.col("store_location"))
    ).groupBy("store_number").agg(F.count(F.lit(1)).alias("rows"))


@register("like_any", q.with_sales(select="""
SELECT category_name, count(*) AS rows FROM sales
WHERE lower(category_name) LIKE '%liqueur%' OR lower(category_name) LIKE '%triple sec%'
   OR lower(category_name) LIKE '%cordial%' GROUP BY 1"""))
def like_any(spark, sf_dir):
    return sales(spark, sf_dir, "category_name").where(
        text.contains_any(F.lower("category_name"), ["liqueur", "triple sec", "cordial"])
    ).groupBy("category_name").agg(F.count(F.lit(1)).alias("rows"))


@register("filter_scalar_subquery", q.with_sales(q.TTM, select=f"""
SELECT count(*) AS rows, CAST({q.money()} AS DOUBLE) AS sales FROM ttm"""))
def filter_scalar_subquery(spark, sf_dir):
    kept = filters.trailing_year_late(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    return kept.agg(F.count(F.lit(1)).alias("rows"), sum_sales())


# ------------------------------------------------------------ joins

@register("join_cross_one_row", q.with_sales(q.TTM, select=f"""
SELECT liquor_category, CAST({q.money()} AS DOUBLE) AS sales FROM ttm GROUP BY 1"""))
def join_cross_one_row(spark, sf_dir):
    lines = sales(spark, sf_dir, "sale_date", "sale_dollars", "liquor_category")
    return filters.trailing_year_late(lines).groupBy("liquor_category").agg(sum_sales())


POINTS = """
points AS (
  SELECT sale_date, CAST(total AS DOUBLE) AS total,
         CAST(date_diff('day', (SELECT min(sale_date) FROM daily), sale_date) AS INTEGER) AS x
  FROM daily
)"""


@register("join_cross_model", q.with_sales(q.DAILY, POINTS, """
model AS (SELECT regr_slope(total, x) AS slope, regr_intercept(total, x) AS intercept FROM points)
""", select="""
SELECT sale_date, x, round(intercept + slope * x, 0) AS trend_line FROM points, model"""))
def join_cross_model(spark, sf_dir):
    daily = reports.daily_totals(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    first = daily.agg(F.min("sale_date").alias("first")).scalar()
    points = daily.select(
        "sale_date", F.datediff("sale_date", first).alias("x"),
        F.col("sale_dollars").cast("double").alias("total"))
    return rolling.with_trend(points, "x", "total", "line").select(
        "sale_date", "x", F.round("line", 0).alias("trend_line"))


def _daily_mean(days: int) -> str:
    return q.with_sales(q.DAILY, select=f"""
SELECT sale_date, CAST(round(total, 0) AS DOUBLE) AS sales,
       round(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 0) AS moving_avg
FROM daily WINDOW w AS (ORDER BY sale_date
  RANGE BETWEEN INTERVAL {days - 1} DAY PRECEDING AND CURRENT ROW)""")


@register("join_range_self", q.with_sales(q.DAILY, select="""
SELECT d.sale_date, CAST(round(d.total, 0) AS DOUBLE) AS sales,
       round((SELECT CAST(sum(p.total) AS DOUBLE) / count(p.total) FROM daily p
              WHERE p.sale_date BETWEEN d.sale_date - INTERVAL 27 DAY AND d.sale_date), 0) AS moving_avg
FROM daily d"""))
def join_range_self(spark, sf_dir):
    daily = reports.daily_totals(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    means = rolling.rolling_mean_days_joined(daily, "sale_dollars", "sale_date", 28, "mean")
    return means.select("sale_date", reports.whole(F.col("sale_dollars")).alias("sales"),
                        F.round("mean", 0).alias("moving_avg"))


def _model(spark, sf_dir):
    return semantic.SalesModel(
        fact=lambda *columns: sales(spark, sf_dir, *columns),
        calendar=lambda: calendar.calendar_of(sales(spark, sf_dir, "sale_date")),
        stores=lambda: _store_dim(spark, sf_dir))


@register("join_fact_date", q.with_sales(select=f"""
SELECT sale_year AS year, strftime(sale_date, '%A') AS dayofweek,
       {q.whole(q.money())} AS total_sales, CAST(sum(bottles_sold) AS BIGINT) AS total_bottles_sold
FROM sales GROUP BY 1, 2"""))
def join_fact_date(spark, sf_dir):
    return _model(spark, sf_dir).query(
        metrics=["TOTAL_SALES", "TOTAL_BOTTLES_SOLD"], dimensions=["YEAR", "DAYOFWEEK"])


@register("join_fact_store", q.with_sales(q.STORES, select=f"""
SELECT store_city, corrected_longitude AS longitude, {q.whole(q.money())} AS total_sales,
       CAST(sum(bottles_sold) AS BIGINT) AS total_bottles_sold
FROM sales s JOIN (SELECT store_number AS number, store_city, longitude AS corrected_longitude
                   FROM stores) ON s.store_number = number
GROUP BY 1, 2"""))
def join_fact_store(spark, sf_dir):
    return _model(spark, sf_dir).query(
        metrics=["TOTAL_SALES", "TOTAL_BOTTLES_SOLD"], dimensions=["STORE_CITY", "Lon"])


@register("join_merge_key", q.with_sales(select="""
SELECT sale_year, count(*) AS rows FROM sales
WHERE sale_year <= 1999 AND invoice_and_item_number NOT IN
  (SELECT invoice_and_item_number FROM sales WHERE sale_year >= 1998)
GROUP BY 1"""))
def join_merge_key(spark, sf_dir):
    lines = sales(spark, sf_dir, KEY, "sale_year")
    target = lines.where(F.col("sale_year") <= 1999)
    source = keyed.dedup_by_key(lines.where(F.col("sale_year") >= 1998))
    return upsert.not_in(target, source).groupBy("sale_year").agg(F.count(F.lit(1)).alias("rows"))


# ------------------------------------------------------------ aggregates and metrics

@register("agg_sum_by_key", q.with_sales(select=f"""
SELECT {q.title('item_description')} AS item, CAST({q.money()} AS DOUBLE) AS sales
FROM sales GROUP BY 1"""))
def agg_sum_by_key(spark, sf_dir):
    groups = sales(spark, sf_dir, "item_description", "sale_dollars").groupBy(
        "item_description").agg(numbers.exact_sum(F.col("sale_dollars")).alias("_sales"))
    return groups.groupBy(text.title_case(F.col("item_description")).alias("item")).agg(
        F.sum("_sales").cast("double").alias("sales"))


@register("agg_daily_total", q.with_sales(select=f"""
SELECT sale_date, CAST({q.money()} AS DOUBLE) AS sales FROM sales GROUP BY 1"""))
def agg_daily_total(spark, sf_dir):
    daily = reports.daily_totals(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    return daily.select("sale_date", F.col("sale_dollars").cast("double").alias("sales"))


@register("agg_max_date", q.with_sales(select="SELECT max(sale_date) AS max_date FROM sales"))
def agg_max_date(spark, sf_dir):
    return sales(spark, sf_dir, "sale_date").agg(F.max("sale_date").alias("max_date"))


@register("agg_count", q.with_sales(select="""
SELECT count(*) AS rows FROM sales WHERE sale_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31'"""))
def agg_count(spark, sf_dir):
    low, high = dates.last_full_month(AS_OF)
    return sales(spark, sf_dir, "sale_date").where(
        F.col("sale_date").between(F.lit(low), F.lit(high))
    ).agg(F.count(F.lit(1)).alias("rows"))


@register("agg_regression", q.with_sales(q.DAILY, POINTS, select="""
SELECT round(regr_slope(total, x), 3) AS slope, round(regr_intercept(total, x), 1) AS intercept
FROM points"""))
def agg_regression(spark, sf_dir):
    daily = reports.daily_totals(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    first = daily.agg(F.min("sale_date").alias("first")).scalar()
    points = daily.select(
        F.datediff("sale_date", first).alias("x"), F.col("sale_dollars").cast("double").alias("y"))
    return points.agg(F.round(F.regr_slope("y", "x"), 3).alias("slope"),
                      F.round(F.regr_intercept("y", "x"), 1).alias("intercept"))


@register("dedup_by_key", q.with_sales(q.DEDUP, select=f"""
SELECT {", ".join(PLAIN_SALES)} FROM unique_sales"""))
def dedup_by_key(spark, sf_dir):
    return keyed.dedup_by_key(sales(spark, sf_dir, *PLAIN_SALES))


def _metric(name: str, value: str, digits: int | None = None) -> None:
    column = name.lower()
    if digits is not None:
        value = f"round({value}, {digits})"
    needed = sorted(metrics.METRICS[name].columns())
    labels = {
        "TOTAL_SALES": "metric_total_sales", "TOTAL_BOTTLES_SOLD": "metric_total_bottles",
        "TOTAL_VOLUME_LITERS": "metric_total_liters",
        "TOTAL_VOLUME_GALLONS": "metric_total_gallons",
        "AVG_PRICE_PER_BOTTLE": "metric_avg_price", "AVG_UNIT_COST": "metric_avg_unit_cost",
        "GROSS_MARGIN_DOLLARS": "metric_gross_margin", "GROSS_MARGIN_RATE": "metric_margin_rate",
    }

    @register(labels[name], q.with_sales(select=f"""
SELECT liquor_category, sale_year, {value} AS {column} FROM sales GROUP BY 1, 2"""))
    def metric(spark, sf_dir):
        lines = sales(spark, sf_dir, "liquor_category", "sale_year", *needed)
        measured = metrics.measure(lines, [name], "liquor_category", "sale_year")
        return measured if digits is None else measured.withColumn(column, F.round(column, digits))


_metric("TOTAL_SALES", f"CAST({q.money()} AS DOUBLE)")
_metric("TOTAL_BOTTLES_SOLD", "CAST(sum(bottles_sold) AS BIGINT)")
_metric("TOTAL_VOLUME_LITERS", "CAST(sum(CAST(volume_sold_liters AS DECIMAL(38,10))) AS DOUBLE)")
_metric("TOTAL_VOLUME_GALLONS",
        "CAST(sum(CAST(volume_sold_gallons AS DECIMAL(38,10))) AS DOUBLE)", 1)
_metric("AVG_PRICE_PER_BOTTLE",
        f"CAST({q.money()} AS DOUBLE) / nullif(CAST(sum(bottles_sold) AS DOUBLE), 0)", 6)
_metric("AVG_UNIT_COST",
        f"CAST(sum({q.COST}) AS DOUBLE) / nullif(CAST(sum(bottles_sold) AS DOUBLE), 0)", 6)
_metric("GROSS_MARGIN_DOLLARS", f"CAST(sum({q.MARGIN}) AS DOUBLE)")
_metric("GROSS_MARGIN_RATE",
        f"CAST(sum({q.MARGIN}) AS DOUBLE) / nullif(CAST({q.money()} AS DOUBLE), 0)", 6)


# ------------------------------------------------------------ windows, sorts, limits

@register("win_latest_per_key", q.with_sales(q.STORES, select="""
SELECT store_number, store_name, address, city, zip_code, county, county_number, sale_date,
       longitude FROM latest_store"""))
def win_latest_per_key(spark, sf_dir):
    latest = stores.latest_per_store(_store_sales(spark, sf_dir))
    return latest.withColumn(
        "longitude", variant.longitude_of(F.col("store_location"))).drop("store_location", KEY)


@register("win_rolling_rows", q.with_sales(q.MONTHLY, select="""
SELECT month, CAST(total AS DOUBLE) AS sales,
       round(CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w, 0) AS mean
FROM monthly WINDOW w AS (ORDER BY month ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"""))
def win_rolling_rows(spark, sf_dir):
    totals = rolling.totals_by(
        sales(spark, sf_dir, "sale_date", "sale_dollars"),
        dates.month_start(F.col("sale_date")), "month",
        sales=numbers.exact_sum(F.col("sale_dollars")))
    return rolling.rolling_mean_rows(totals, "sales", "month", 12, "mean").select(
        "month", F.col("sales").cast("double").alias("sales"), F.round("mean", 0).alias("mean"))


@register("win_rolling_days", _daily_mean(28))
def win_rolling_days(spark, sf_dir):
    daily = reports.daily_totals(sales(spark, sf_dir, "sale_date", "sale_dollars"))
    means = rolling.rolling_mean_days(daily, "sale_dollars", "sale_date", 28, "mean")
    return means.select("sale_date", reports.whole(F.col("sale_dollars")).alias("sales"),
                        F.round("mean", 0).alias("moving_avg"))


@register("win_global_min", q.with_sales(q.DAILY, POINTS, select="SELECT sale_date, x FROM points"))
def win_global_min(spark, sf_dir):
    daily = sales(spark, sf_dir, "sale_date").distinct()
    first = daily.agg(F.min("sale_date").alias("first")).scalar()
    return daily.select("sale_date", F.datediff("sale_date", first).alias("x"))


@register("sort_desc_alias", q.with_sales(select=f"""
SELECT county AS "County", {q.whole(q.money())} AS "Sales" FROM sales GROUP BY 1
ORDER BY "Sales" DESC NULLS FIRST, 1"""))
def sort_desc_alias(spark, sf_dir):
    totals = sales(spark, sf_dir, "county", "sale_dollars").groupBy(
        F.col("county").alias("County")).agg(
        reports.whole(numbers.exact_sum(F.col("sale_dollars"))).alias("Sales"))
    return totals.orderBy(F.col("Sales").desc_nulls_first(), "County")


LOOK = ["sale_date", KEY, "item_number", "store_number", "sale_dollars"]


@register("sort_multi", q.with_sales(select=f"""
SELECT {", ".join(LOOK)} FROM sales ORDER BY {", ".join(LOOK)}"""))
def sort_multi(spark, sf_dir):
    return sales(spark, sf_dir, *LOOK).orderBy(*LOOK)


@register("limit_n", q.with_sales(select=f"""
SELECT {", ".join(LOOK)} FROM sales ORDER BY {", ".join(LOOK)} LIMIT 20"""))
def limit_n(spark, sf_dir):
    return sales(spark, sf_dir, *LOOK).orderBy(*LOOK).limit(20)


@register("top_n", q.with_sales(q.TTM, select=f"{ITEM_REPORT} LIMIT 10"))
def top_n(spark, sf_dir):
    lines = sales(spark, sf_dir, "sale_date", "sale_dollars", "item_description")
    return reports.ttm_top_items(lines, n=10)


# ------------------------------------------------------------ table mutation

# Two overlapping halves of the deduplicated sales; the later one has raised prices.
SLICES = """
target AS (SELECT invoice_and_item_number, sale_date, sale_year, sale_month, sale_dollars
           FROM unique_sales WHERE sale_year <= 1999),
source AS (SELECT invoice_and_item_number, sale_date, sale_year, sale_month,
                  sale_dollars + 1 AS sale_dollars
           FROM unique_sales WHERE sale_year >= 1998),
merged AS (SELECT * FROM source UNION ALL
           SELECT * FROM target WHERE invoice_and_item_number NOT IN
             (SELECT invoice_and_item_number FROM source))"""


def _slices(spark, sf_dir, *columns):
    lines = keyed.unique_by_key(sales(spark, sf_dir, *(columns or PLAIN_SALES)))
    raised = F.col("sale_dollars") + 1
    return (lines.where(F.col("sale_year") <= 1999),
            lines.where(F.col("sale_year") >= 1998).withColumn("sale_dollars", raised))


@register("merge_upsert", q.with_sales(q.DEDUP, SLICES, select="""
SELECT invoice_and_item_number, sale_date, sale_dollars FROM merged"""))
def merge_upsert(spark, sf_dir):
    target, source = _slices(spark, sf_dir)
    return upsert.merge_upsert(target, source).select(KEY, "sale_date", "sale_dollars")


@register("sink_silver_upsert", q.with_sales(q.DEDUP, SLICES, select=f"""
SELECT sale_year, sale_month, count(*) AS rows, CAST({q.money()} AS DOUBLE) AS sales
FROM merged GROUP BY 1, 2"""))
def sink_silver_upsert(spark, sf_dir):
    target, source = _slices(spark, sf_dir)
    no_location = F.lit(None).cast("variant").alias("store_location")
    stored = MonthTable(spark, fresh_folder(spark, "sales"))
    stored.upsert(target.select("*", no_location))
    stored.upsert(source.select("*", no_location))
    return stored.read().groupBy("sale_year", "sale_month").agg(
        F.count(F.lit(1)).alias("rows"), sum_sales())


@register("delete_range", q.with_sales(select="""
SELECT sale_year, sale_month, count(*) AS rows FROM sales
WHERE NOT (sale_date BETWEEN DATE '2001-07-01' AND DATE '2001-07-31') GROUP BY 1, 2"""))
def delete_range(spark, sf_dir):
    lines = sales(spark, sf_dir, "sale_date", "sale_year", "sale_month")
    kept = upsert.delete_range(lines, *dates.last_full_month(AS_OF))
    return kept.groupBy("sale_year", "sale_month").agg(F.count(F.lit(1)).alias("rows"))


@register("replay_month", q.with_sales(q.DEDUP, select="""
SELECT step, CASE WHEN step = 'after_delete' THEN 0 ELSE rows END AS rows
FROM (SELECT count(*) AS rows FROM unique_sales WHERE sale_year = 2001 AND sale_month = 7),
     (VALUES ('before'), ('after_delete'), ('after_reload')) steps(step)"""))
def replay_month(spark, sf_dir):
    store = staged.own_store(spark, sf_dir)
    return loads.replay_month(spark, store, (2001, 7))


# ------------------------------------------------------------ streaming and incremental

def _raw_table(spark, sf_dir) -> str:
    folder = fresh_folder(spark, "raw")
    landing.scan_documents(spark, staged.landing_folder(spark, sf_dir)).write.option(
        "compression", TABLE_CODEC).parquet(folder)
    return folder


@register("stream_append_only", q.with_sales(select="""
SELECT CAST(1 AS INTEGER) AS run, count(*) AS rows FROM sales
UNION ALL SELECT 2, 0
UNION ALL SELECT 3, count(*) FROM sales WHERE sale_year = 1996"""))
def stream_append_only(spark, sf_dir):
    raw, folder = _raw_table(spark, sf_dir), fresh_folder(spark, "feed")
    runs = []
    for run in (1, 2, 3):
        if run == 3:
            again = landing.scan_documents(
                spark, staged.landing_folder(spark, sf_dir), years=[1996])
            again.write.mode("append").option("compression", TABLE_CODEC).parquet(raw)
        runs.append((run, feed.unread_rows(spark, raw, f"{folder}/checkpoint", f"{folder}/out")))
    return spark.createDataFrame(runs, "run int, rows bigint")


@register("stream_landing", q.with_sales(select="""
SELECT sale_year AS year, count(*) AS rows FROM sales GROUP BY 1"""))
def stream_landing(spark, sf_dir):
    folder = fresh_folder(spark, "feed")
    for _ in range(2):
        feed.stream_landing(
            spark, staged.landing_folder(spark, sf_dir), f"{folder}/raw", f"{folder}/checkpoint")
    stamp = variant.text_at(F.col("raw"), "date")
    return spark.read.parquet(f"{folder}/raw").groupBy(
        F.year(transform.sale_day(stamp)).alias("year")).agg(F.count(F.lit(1)).alias("rows"))


@register("stream_upsert", q.with_sales(q.DEDUP, select="""
SELECT invoice_and_item_number, sale_date, store_number, item_number, liquor_category,
       bottles_sold, sale_dollars FROM unique_sales"""))
def stream_upsert(spark, sf_dir):
    raw, folder = _raw_table(spark, sf_dir), fresh_folder(spark, "stream")
    stored = MonthTable(spark, f"{folder}/sales")
    for _ in range(2):
        feed.stream_upsert(
            spark, raw, stored, f"{folder}/checkpoint", quarantine=f"{folder}/quarantine")
    return stored.read().select(
        KEY, "sale_date", "store_number", "item_number", "liquor_category", "bottles_sold",
        "sale_dollars")


@register("load_latest", q.with_sales(q.DEDUP, select="""
SELECT sale_year, sale_month, count(*) AS rows FROM unique_sales
WHERE sale_date < DATE '2001-08-01' GROUP BY 1, 2"""))
def load_latest(spark, sf_dir):
    store, _ = staged.loaded_store(spark, sf_dir)
    return store.sales(spark).read().groupBy("sale_year", "sale_month").agg(
        F.count(F.lit(1)).alias("rows"))


def _labels(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    year, month = F.year(day).cast("string"), F.month(day)
    forms = F.array(
        F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy"),
        F.date_format(day, "yyyy-MM-dd"), F.concat(year, F.lit("-"), (month + 6).cast("string")),
        F.concat(year, F.lit("-x")), F.concat((F.year(day) + 3).cast("string"), F.lit("-"), month),
        F.concat((F.year(day) - 5).cast("string"), F.lit("-"), month), F.lit("2000-00"))
    return table(spark, sf_dir, "orders").select(F.explode(forms).alias("label"))


@register("month_plan", """
WITH days AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m FROM orders),
valid AS (
  SELECT y, m FROM days UNION SELECT y, m + 6 FROM days
  UNION SELECT y + 3, m FROM days UNION SELECT y - 5, m FROM days)
SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month FROM valid
WHERE m BETWEEN 1 AND 12 AND y >= 1995 AND y * 12 + m <= 2001 * 12 + 7""")
def month_plan(spark, sf_dir):
    last_full, _ = dates.last_full_month(AS_OF)
    return schedule.month_plan(_labels(spark, sf_dir), last_full, first_year=1995)


@register("month_plan_years", """
SELECT CAST(y AS INTEGER) AS year, CAST(m AS INTEGER) AS month
FROM (SELECT DISTINCT year(o_orderdate) + 2 AS y FROM orders), range(1, 13) months(m)
WHERE y BETWEEN 1995 AND 2001 AND y * 12 + m <= 2001 * 12 + 7""")
def month_plan_years(spark, sf_dir):
    last_full, _ = dates.last_full_month(AS_OF)
    years = table(spark, sf_dir, "orders").select((F.year("o_orderdate") + 2).alias("year"))
    return schedule.year_plan(years, last_full, first_year=1995)


@register("month_gap", """
SELECT strftime(d, '%Y-%m') AS label FROM (SELECT unnest(generate_series(
  date_trunc('month', max(o_orderdate)) + INTERVAL 1 MONTH, TIMESTAMP '2002-06-01',
  INTERVAL 1 MONTH)) AS d FROM orders)""")
def month_gap(spark, sf_dir):
    return schedule.month_gap(
        sales(spark, sf_dir, "sale_date"), date(2002, 6, 1), first_year=1995)


@register("month_gap_holes", """
WITH present AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS label FROM orders)
SELECT strftime(d, '%Y-%m') AS label FROM (SELECT unnest(generate_series(
  TIMESTAMP '1994-01-01', TIMESTAMP '2002-06-01', INTERVAL 1 MONTH)) AS d)
WHERE strftime(d, '%Y-%m') NOT IN (SELECT label FROM present)""")
def month_gap_holes(spark, sf_dir):
    return schedule.month_gap(
        sales(spark, sf_dir, "sale_date"), date(2002, 6, 1), first_year=1994, fill_holes=True)


# ------------------------------------------------------------ named reports

@register("ttm_sales", q.with_sales(q.TTM, select=f"""
SELECT '$' || format('{{:,}}', CAST(round({q.money()}, 0) AS BIGINT)) AS ttm_sales FROM ttm"""))
def ttm_sales(spark, sf_dir):
    return reports.ttm_sales(sales(spark, sf_dir, "sale_date", "sale_dollars"))


@register("ttm_sales_by_category", q.with_sales(q.TTM, select=CATEGORY_REPORT))
def ttm_sales_by_category(spark, sf_dir):
    return reports.ttm_sales_by_category(
        sales(spark, sf_dir, "sale_date", "sale_dollars", "liquor_category"))


@register("ttm_top_items", q.with_sales(q.TTM, select=ITEM_REPORT))
def ttm_top_items(spark, sf_dir):
    return reports.ttm_top_items(
        sales(spark, sf_dir, "sale_date", "sale_dollars", "item_description"))


@register("monthly_sales_ttm_avg", _monthly_report(36, 12))
def monthly_sales_ttm_avg(spark, sf_dir):
    return reports.monthly_sales(sales(spark, sf_dir, "sale_date", "sale_dollars"), as_of=AS_OF)


DAILY_TREND = q.with_sales("""
daily AS (
  SELECT sale_date, sum(CAST(sale_dollars AS DECIMAL(38,10))) AS total FROM sales
  WHERE sale_date >= DATE '1998-01-01' - INTERVAL 27 DAY GROUP BY 1
)""", """
ma AS (
  SELECT sale_date, CAST(sum(total) OVER w AS DOUBLE) / count(total) OVER w AS mean
  FROM daily WINDOW w AS (ORDER BY sale_date RANGE BETWEEN INTERVAL 27 DAY PRECEDING AND CURRENT ROW)
)""", """
points AS (
  SELECT sale_date, mean, date_diff('day', min(sale_date) OVER (), sale_date) AS x
  FROM ma WHERE sale_date >= DATE '1998-01-01'
)""", """
model AS (SELECT regr_slope(mean, x) AS slope, regr_intercept(mean, x) AS intercept FROM points)
""", select="""
SELECT sale_date, round(mean, 0) AS moving_avg, round(intercept + slope * x, 0) AS trend_line
FROM points, model ORDER BY sale_date""")


@register("daily_ma_trend", DAILY_TREND)
def daily_ma_trend(spark, sf_dir):
    return reports.daily_trend(
        sales(spark, sf_dir, "sale_date", "sale_dollars"), visible_start=date(1998, 1, 1))


@register("dim_store_location", q.with_sales(q.STORES, select="SELECT * FROM stores"))
def dim_store_location(spark, sf_dir):
    return _store_dim(spark, sf_dir).drop("store_location")


@register("dim_store_location_all", q.with_sales(
    q.STORES.replace("WHERE longitude IS NOT NULL\n", ""), select="SELECT * FROM stores"))
def dim_store_location_all(spark, sf_dir):
    return _store_dim(spark, sf_dir, keep_unlocated=True).drop("store_location")


# ------------------------------------------------------------ semantic model

@register("semantic_query", q.with_sales(q.STORES, select=f"""
SELECT liquor_category AS liquor_family, strftime(sale_date, '%B') AS month, city AS store_city,
       {q.whole(q.money())} AS total_sales, CAST(sum(bottles_sold) AS BIGINT) AS total_bottles_sold,
       round(CAST(sum({q.MARGIN}) AS DOUBLE) / nullif(CAST({q.money()} AS DOUBLE), 0), 6) AS gross_margin_rate
FROM sales WHERE sale_year BETWEEN 1999 AND 2000 AND bottle_volume_ml >= 375
  AND isodow(sale_date) <= 5 AND store_number IN (SELECT store_number FROM stores)
GROUP BY 1, 2, 3 HAVING sum(bottles_sold) > 20"""))
def semantic_query(spark, sf_dir):
    result = _model(spark, sf_dir).query(
        metrics=["TOTAL_SALES", "TOTAL_BOTTLES_SOLD", "GROSS_MARGIN_RATE"],
        dimensions=["LIQUOR_FAMILY", "MONTH", "STORE_CITY"],
        where=[("SALE_YEAR", "between", (1999, 2000)), ("BOTTLE_VOLUME_ML", ">=", 375),
               ("IS_WEEKDAY", "=", True), ("TOTAL_BOTTLES_SOLD", ">", 20)])
    return result.withColumn("gross_margin_rate", F.round("gross_margin_rate", 6))


@register("semantic_resolve", q.with_sales(select=f"""
SELECT liquor_category AS liquor_family, item_description AS item, {q.whole(q.money())} AS total_sales
FROM sales GROUP BY 1, 2"""))
def semantic_resolve(spark, sf_dir):
    model = _model(spark, sf_dir)
    return model.query(metrics=["revenue"], dimensions=["Normalized Category", "product name"])


@register("semantic_validate", q.with_sales(q.STORES, select="""
SELECT 'SALES' AS "table", CAST(sum(n) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS null_keys,
       count(*) FILTER (n > 1) AS duplicate_keys
FROM (SELECT count(*) AS n FROM sales GROUP BY invoice_and_item_number)
UNION ALL SELECT 'DIM_STORE_LOCATION', count(*), 0, count(*) - count(DISTINCT store_number) FROM stores
UNION ALL SELECT 'DATE_DIM', CAST(date_diff('day', make_date(min(sale_year), 1, 1),
                 make_date(max(sale_year), 12, 31)) + 1 AS BIGINT), 0, 0 FROM sales"""))
def semantic_validate(spark, sf_dir):
    model = _model(spark, sf_dir)
    model.validate()
    return model.key_report()


@register("semantic_rounding", q.with_sales(select=f"""
SELECT invoice_and_item_number, item_description AS item, round(sale_dollars, 2) AS sale_dollars,
       round(state_bottle_cost, 2) AS state_bottle_cost, bottles_sold
FROM sales"""))
def semantic_rounding(spark, sf_dir):
    return _model(spark, sf_dir).query(
        dimensions=[KEY, "ITEM", "SALE_DOLLARS", "STATE_BOTTLE_COST", "BOTTLES_SOLD"])


@register("semantic_rounding_totals", q.with_sales(select=f"""
SELECT vendor_name, {q.whole(q.money())} AS total_sales,
       {q.whole(f'sum({q.MARGIN})')} AS gross_margin_dollars FROM sales GROUP BY 1"""))
def semantic_rounding_totals(spark, sf_dir):
    return _model(spark, sf_dir).query(
        metrics=["TOTAL_SALES", "GROSS_MARGIN_DOLLARS"], dimensions=["VENDOR_NAME"])


@register("semantic_lines_by_store", q.with_sales("""
located AS (SELECT DISTINCT store_number AS number FROM sales WHERE longitude IS NOT NULL)""",
                                                 select="""
SELECT invoice_and_item_number, city AS store_city, strftime(sale_date, '%b%Y') AS monthyear,
       sale_dollars
FROM sales JOIN located ON store_number = number"""))
def semantic_lines_by_store(spark, sf_dir):
    return _model(spark, sf_dir).query(
        dimensions=[KEY, "STORE_CITY", "MONTHYEAR", "SALE_DOLLARS"])


def _report_columns(*columns):
    return lambda spark, sf_dir: sales(spark, sf_dir, "sale_date", "sale_dollars", *columns)


@register("verified_queries", q.with_sales(q.TTM, select=f"""
SELECT item AS "Item", ttm_sales AS "TTM Sales" FROM ({ITEM_REPORT})"""))
def verified_queries(spark, sf_dir):
    lines = _report_columns("item_description")(spark, sf_dir)
    return reports.with_labels(
        verified.ask(lines, "What are the top N best selling items for the past TTM?"))


@register("verified_ttm_sales", q.with_sales(q.TTM, select=f"""
SELECT '$' || format('{{:,}}', CAST(round({q.money()}, 0) AS BIGINT)) AS ttm_sales FROM ttm"""))
def verified_ttm_sales(spark, sf_dir):
    return verified.ask(
        _report_columns()(spark, sf_dir), "What is our trailing twelve month (TTM) sales?")


@register("verified_monthly", _monthly_report(36, 12).replace(
    "SELECT month AS sale_date", 'SELECT month AS "Sale Month"').replace(
    "AS monthly_sales", 'AS "Monthly Sales"').replace("AS ttm_avg_sales", 'AS "TTM Avg Sales"'))
def verified_monthly(spark, sf_dir):
    return reports.with_labels(verified.ask(
        _report_columns()(spark, sf_dir), "MONTHLY_SALES_WITH_TTM_AVG", as_of=AS_OF))


# ------------------------------------------------------------ business questions

def _anchor(*shifts: tuple[str, int]) -> str:
    listed = ", ".join(
        f"CAST(month + INTERVAL ({shift}) MONTH AS DATE) AS {name}" for name, shift in shifts)
    return f"""
marks AS (SELECT {listed} FROM (SELECT date_trunc('month', max(sale_date)) AS month FROM sales))"""


YOY = q.with_sales(_anchor(("a", 0), ("b", 1), ("c", -12), ("d", -11)), f"""
families AS (
  SELECT liquor_category AS family, {q.part_in(q.SALE, 'a', 'b')} AS latest,
         {q.part_in(q.SALE, 'c', 'd')} AS prior
  FROM sales, marks WHERE (sale_date >= a AND sale_date < b) OR (sale_date >= c AND sale_date < d)
  GROUP BY 1
)""", """
placed AS (
  SELECT CAST(0 AS INTEGER) AS place, 'TOTAL' AS family, sum(latest) AS latest, sum(prior) AS prior FROM families
  UNION ALL
  SELECT CAST(row_number() OVER (ORDER BY latest - prior DESC, family) AS INTEGER), family, latest, prior
  FROM families
)""", select=f"""
SELECT place, family, {q.whole('latest')} AS latest_sales, {q.whole('prior')} AS prior_sales,
       {q.whole('latest - prior')} AS change, {q.share('latest - prior', 'prior')} AS pct_change
FROM placed WHERE place <= 3 ORDER BY place""")


@register("q_month_yoy", YOY)
def q_month_yoy(spark, sf_dir):
    return questions.month_yoy(_report_columns("liquor_category")(spark, sf_dir))


@register("q_top_items_t3m_mom", q.with_sales(
    _anchor(("a", -2), ("b", -1), ("c", 0), ("d", 1)), f"""
items AS (
  SELECT item_description AS item, {q.part_in(q.SALE, 'a', 'd')} AS t3m,
         {q.part_in(q.SALE, 'c', 'd')} AS latest, {q.part_in(q.SALE, 'b', 'c')} AS prior
  FROM sales, marks WHERE sale_date >= a AND sale_date < d GROUP BY 1
)""", select=f"""
SELECT item, {q.whole('t3m')} AS t3m_sales, {q.whole('latest')} AS latest_month_sales,
       {q.whole('prior')} AS prior_month_sales, {q.share('latest - prior', 'prior')} AS mom_change
FROM items ORDER BY t3m DESC, item LIMIT 10"""))
def q_top_items_t3m_mom(spark, sf_dir):
    return questions.top_items_with_mom(_report_columns("item_description")(spark, sf_dir))


@register("q_weekly_trend_outliers", q.with_sales("""
last AS (SELECT CAST(date_trunc('week', max(sale_date)) AS DATE) AS week FROM sales)""", """
points AS (
  SELECT CAST(date_trunc('week', sale_date) AS DATE) AS week,
         CAST(date_diff('day', any_value(last.week) - INTERVAL 25 WEEK,
                        date_trunc('week', sale_date)) // 7 AS INTEGER) AS x,
         CAST(sum(CAST(sale_dollars AS DECIMAL(38,10))) AS DOUBLE) AS sales
  FROM sales, last
  WHERE sale_date >= last.week - INTERVAL 25 WEEK AND sale_date < last.week + INTERVAL 1 WEEK
  GROUP BY date_trunc('week', sale_date)
)""", """
model AS (SELECT regr_slope(sales, x) AS slope, regr_intercept(sales, x) AS intercept,
                 avg(sales) + 2 * stddev_samp(sales) AS high FROM points)""", select="""
SELECT week, x, round(sales, 0) AS sales, round(intercept + slope * x, 0) AS trend,
       round(slope, 2) AS slope, round(intercept, 2) AS intercept, sales > high AS is_outlier
FROM points, model ORDER BY week"""))
def q_weekly_trend_outliers(spark, sf_dir):
    return questions.weekly_outliers(_report_columns()(spark, sf_dir))


@register("q_county_yoy_bottles", q.with_sales(_anchor(("a", -23), ("b", -11), ("c", 1)), f"""
pairs AS (
  SELECT county, liquor_category AS family,
         {q.part_in('bottles_sold', 'b', 'c')} AS now, {q.part_in('bottles_sold', 'a', 'b')} AS before
  FROM sales, marks WHERE sale_date >= a AND sale_date < c GROUP BY 1, 2
)""", """
leaders AS (
  SELECT county, family FROM (
    SELECT *, row_number() OVER (PARTITION BY county ORDER BY now DESC, family) AS place FROM pairs)
  WHERE place = 1
)""", select=f"""
SELECT p.county, CAST(sum(now) AS BIGINT) AS ttm_bottles, CAST(sum(before) AS BIGINT) AS prior_bottles,
       {q.share('sum(now) - sum(before)', 'sum(before)')} AS growth,
       any_value(l.family) AS leading_family
FROM pairs p JOIN leaders l ON p.county = l.county GROUP BY 1
ORDER BY growth DESC NULLS LAST, 1"""))
def q_county_yoy_bottles(spark, sf_dir):
    return questions.county_growth(
        sales(spark, sf_dir, "sale_date", "county", "liquor_category", "bottles_sold"))


@register("q_ttm_family_share", q.with_sales(
    _anchor(("a", -11), ("b", -1), ("c", 0), ("d", 1)), f"""
families AS (
  SELECT liquor_category AS family, {q.part_in(q.SALE, 'a', 'd')} AS ttm,
         {q.part_in(q.SALE, 'c', 'd')} AS latest, {q.part_in(q.SALE, 'b', 'c')} AS prior
  FROM sales, marks WHERE sale_date >= a AND sale_date < d GROUP BY 1
)""", select=f"""
SELECT family, {q.whole('ttm')} AS ttm_sales, {q.share('ttm', 'sum(ttm) OVER ()')} AS share,
       {q.whole('latest')} AS latest_month_sales, {q.whole('prior')} AS prior_month_sales,
       {q.whole('latest - prior')} AS change
FROM families ORDER BY ttm_sales DESC, family"""))
def q_ttm_family_share(spark, sf_dir):
    return questions.family_shares(_report_columns("liquor_category")(spark, sf_dir))


@register("q_margin_quarter_yoy", q.with_sales("""
marks AS (
  SELECT CAST(quarter AS DATE) AS a, CAST(quarter + INTERVAL 3 MONTH AS DATE) AS b,
         CAST(quarter - INTERVAL 12 MONTH AS DATE) AS c, CAST(quarter - INTERVAL 9 MONTH AS DATE) AS d
  FROM (SELECT date_trunc('quarter', max(sale_date)) AS quarter FROM sales)
)""", f"""
families AS (
  SELECT liquor_category AS family, {q.part_in(q.MARGIN, 'a', 'b')} AS latest,
         {q.part_in(q.MARGIN, 'c', 'd')} AS prior
  FROM sales, marks WHERE (sale_date >= a AND sale_date < b) OR (sale_date >= c AND sale_date < d)
  GROUP BY 1
)""", select=f"""
SELECT family, {q.whole('latest')} AS latest_margin, {q.whole('prior')} AS prior_margin,
       {q.whole('latest - prior')} AS change, {q.share('latest - prior', 'prior')} AS pct_change
FROM families ORDER BY latest_margin DESC, family"""))
def q_margin_quarter_yoy(spark, sf_dir):
    return questions.quarter_margin(_report_columns(
        "liquor_category", "state_bottle_cost", "bottles_sold")(spark, sf_dir))


@register("q_top_margin_items", q.with_sales(_anchor(("a", -5), ("b", -2), ("c", 1)), f"""
items AS (
  SELECT item_description AS item,
         {q.part_in(q.MARGIN, 'b', 'c')} AS margin, {q.part_in(q.SALE, 'b', 'c')} AS sales,
         {q.part_in(q.MARGIN, 'a', 'b')} AS margin_before, {q.part_in(q.SALE, 'a', 'b')} AS sales_before
  FROM sales, marks WHERE sale_date >= a AND sale_date < c GROUP BY 1
)""", select=f"""
SELECT item, {q.whole('margin')} AS margin, {q.share('margin', 'sales')} AS margin_rate,
       {q.share('margin_before', 'sales_before')} AS prior_margin_rate
FROM items ORDER BY items.margin DESC, item LIMIT 10"""))
def q_top_margin_items(spark, sf_dir):
    return questions.top_margin_items(_report_columns(
        "item_description", "state_bottle_cost", "bottles_sold")(spark, sf_dir))


@register("q_margin_rate_trend", q.with_sales(_anchor(("a", -11), ("b", 1)), f"""
points AS (
  SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, sum({q.MARGIN}) AS margin,
         CAST(sum({q.MARGIN}) AS DOUBLE) / nullif(CAST({q.money()} AS DOUBLE), 0) AS rate,
         date_diff('month', any_value(a), date_trunc('month', sale_date)) AS x
  FROM sales, marks WHERE sale_date >= a AND sale_date < b GROUP BY date_trunc('month', sale_date)
)""", """
model AS (SELECT regr_slope(rate, x) AS slope, regr_intercept(rate, x) AS intercept FROM points)
""", select=f"""
SELECT month, {q.whole('margin')} AS margin, round(rate, 6) AS margin_rate,
       round(intercept + slope * x, 6) AS trend,
       coalesce(rate - lag(rate) OVER (ORDER BY month) < -0.02, FALSE) AS is_sharp_drop
FROM points, model ORDER BY month"""))
def q_margin_rate_trend(spark, sf_dir):
    return questions.margin_trend(
        _report_columns("state_bottle_cost", "bottles_sold")(spark, sf_dir))


@register("q_last_month_top3", q.with_sales(_anchor(("a", 0), ("b", 1)), f"""
families AS (
  SELECT liquor_category AS family, sum({q.SALE}) AS total
  FROM sales, marks WHERE sale_date >= a AND sale_date < b GROUP BY 1
)""", select=f"""
SELECT CAST(0 AS INTEGER) AS place, 'TOTAL' AS family, {q.whole('sum(total)')} AS sales FROM families
UNION ALL SELECT * FROM (
  SELECT CAST(row_number() OVER (ORDER BY total DESC, family) AS INTEGER) AS place, family,
         {q.whole('total')} FROM families) WHERE place <= 3"""))
def q_last_month_top3(spark, sf_dir):
    return questions.latest_month_leaders(_report_columns("liquor_category")(spark, sf_dir))


# ------------------------------------------------------------ calendar

def _moved(fixed: str) -> str:
    """Reference SQL: weekday a fixed holiday on a weekend is observed on."""
    return (f"CASE isodow({fixed}) WHEN 6 THEN {fixed} - INTERVAL 1 DAY "
            f"WHEN 7 THEN {fixed} + INTERVAL 1 DAY END")


def _holiday_sql() -> str:
    rows = []
    for name, month, day, since in calendar.FIXED_HOLIDAYS:
        label = name.replace("'", "''")
        fixed = f"make_date(y, {month}, {day})"
        rows.append(f"SELECT CAST({fixed} AS DATE) AS d, '{label}' AS name FROM years WHERE y >= {since}")
        rows.append(f"SELECT CAST({_moved(fixed)} AS DATE), '{label} (observed)' FROM years WHERE y >= {since}")
    for name, month, weekday, earliest, since in calendar.FLOATING_HOLIDAYS:
        label = name.replace("'", "''")
        first = f"make_date(y, {month}, {earliest})"
        rows.append(
            f"SELECT CAST({first} + INTERVAL (({weekday - 1} - dayofweek({first}) + 7) % 7) DAY AS DATE), "
            f"'{label}' FROM years WHERE y >= {since}")
    return " UNION ALL ".join(rows)


CALENDAR_SQL = q.with_sales("""
years AS (SELECT unnest(range(min(sale_year), max(sale_year) + 30)) AS y FROM sales)""", f"""
holidays AS ({_holiday_sql()})""", """
days AS (
  SELECT CAST(d AS DATE) AS d FROM (SELECT unnest(generate_series(
    make_date(min(sale_year), 1, 1), make_date(max(sale_year) + 25, 12, 31), INTERVAL 1 DAY)) AS d FROM sales)
)""", select="""
SELECT CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS datekey, days.d AS date,
  strftime(d, '%A') AS dayofweek, strftime(d, '%a') AS dayofweek_short, strftime(d, '%B') AS month,
  CAST(year(d) AS INTEGER) AS year, CAST(year(d) * 100 + month(d) AS INTEGER) AS yearmonthnum,
  strftime(d, '%b%Y') AS monthyear, CAST(dayofweek(d) + 1 AS INTEGER) AS daynuminweek,
  CAST(day(d) AS INTEGER) AS daynuminmonth, CAST(dayofyear(d) AS INTEGER) AS daynuminyear,
  CAST(month(d) AS INTEGER) AS monthnuminyear, CAST(isoyear(d) AS INTEGER) AS iso_year,
  CAST(week(d) AS INTEGER) AS iso_weeknuminyear, dayofweek(d) = 6 AS is_last_day_in_week,
  d = last_day(d) AS is_last_day_in_month, name IS NOT NULL AS is_holiday,
  isodow(d) <= 5 AS is_weekday, name IS NOT NULL AS is_holiday_us, name AS holiday_name_us
FROM days LEFT JOIN holidays USING (d)""")


@register("date_dim_build", CALENDAR_SQL)
def date_dim_build(spark, sf_dir):
    # the sales end before the youngest holiday begins, so the range goes on for 25 years
    first, last = sales(spark, sf_dir, "sale_date").agg(F.min("sale_date"), F.max("sale_date")).first()
    return calendar.build_calendar(spark, date(first.year, 1, 1), date(last.year + 25, 12, 31))


# ------------------------------------------------------------ data checks

@register("check_stage_load", q.with_sales(select="SELECT count(*) AS rows_loaded FROM sales"))
def check_stage_load(spark, sf_dir):
    return checks.rows_loaded(landing.scan_documents(spark, staged.landing_folder(spark, sf_dir)))


@register("check_stage_sample", """
SELECT count(*) AS rows, count(*) AS readable FROM (SELECT l_orderkey FROM lineitem LIMIT 5)""")
def check_stage_sample(spark, sf_dir):
    # which five rows come is open, so only their number and readability are compared
    sample = checks.sample_rows(
        landing.scan_documents(spark, staged.landing_folder(spark, sf_dir)), 5)
    return sample.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(variant.text_at(F.col("raw"), "invoice_line_no")).alias("readable"))


@register("check_replay_counts", q.with_sales(q.DEDUP, select="""
SELECT step, CASE WHEN step = 'after_delete' THEN 0 ELSE rows END AS rows
FROM (SELECT count(*) AS rows FROM unique_sales WHERE sale_year = 2000 AND sale_month = 2),
     (VALUES ('before'), ('after_delete'), ('after_reload')) steps(step)"""))
def check_replay_counts(spark, sf_dir):
    store = staged.own_store(spark, sf_dir)
    return loads.replay_month(spark, store, (2000, 2))


@register("check_row_counts", q.with_sales(select="""
SELECT 'raw' AS relation, count(*) AS rows FROM sales
UNION ALL SELECT 'sales', count(DISTINCT invoice_and_item_number) FROM sales"""))
def check_row_counts(spark, sf_dir):
    store = staged.whole_store(spark, sf_dir)
    return checks.row_counts(
        raw=spark.read.parquet(store.raw), sales=store.sales(spark).read())


@register("check_newest_rows", q.with_sales(q.DEDUP, select="""
SELECT invoice_and_item_number, sale_date, store_number, sale_dollars FROM unique_sales
ORDER BY sale_date DESC, invoice_and_item_number LIMIT 5"""))
def check_newest_rows(spark, sf_dir):
    store = staged.whole_store(spark, sf_dir)
    return checks.newest_rows(store.sales(spark).read(), 5).select(
        KEY, "sale_date", "store_number", "sale_dollars")
