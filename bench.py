"""Benchmark of the headline queries. Prints one JSON line.

Each rewrite is timed next to the literal form of the same query (one-row cross join,
correlated range subquery, full-table rewrite), on the same data, warm, as a median.
"""

from __future__ import annotations

from datetime import date
import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.catalog.queries import QUERIES
from shelfscan.operators import keyed, upsert
from shelfscan.operators.months import MonthTable
from shelfscan.plans import reports
from shelfscan.schemas import SALES
from shelfscan.session import fresh_folder, local_session
from shelfscan.sources import testdata

HEADLINES = [
    "ttm_sales", "ttm_sales_by_category", "ttm_top_items", "monthly_sales_ttm_avg",
    "daily_ma_trend", "dim_store_location", "date_dim_build", "semantic_query",
    "join_fact_store", "metric_margin_rate", "dedup_by_key", "merge_upsert", "page_assign",
    "rename_project", "classify_family", "q_month_yoy", "q_top_items_t3m_mom",
    "q_weekly_trend_outliers", "q_county_yoy_bottles", "q_ttm_family_share",
    "q_margin_quarter_yoy", "q_top_margin_items", "q_margin_rate_trend",
]


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def timed(action, repeats: int) -> float:
    action()
    spans = []
    for _ in range(repeats):
        start = time.perf_counter()
        action()
        spans.append(time.perf_counter() - start)
    return round(statistics.median(spans), 3)


def stored_sales(spark: SparkSession, sf_dir: str) -> MonthTable:
    """The deduplicated sales as a month-partitioned table."""
    table = MonthTable(spark, fresh_folder(spark, "bench"))
    table.upsert(keyed.dedup_by_key(testdata.sales(spark, sf_dir)))
    return table


def literal_category(spark: SparkSession, lines: DataFrame) -> DataFrame:
    lines.createOrReplaceTempView("bench_lines")
    return spark.sql("""
        WITH newest AS (SELECT trunc(max(sale_date), 'MM') AS month FROM bench_lines)
        SELECT initcap(liquor_category) AS liquor_category, round(sum(sale_dollars), 0) AS ttm_sales
        FROM bench_lines CROSS JOIN newest
        WHERE sale_date >= add_months(month, -11) AND sale_date < add_months(month, 1)
        GROUP BY 1 ORDER BY 2 DESC""")


def literal_trend(spark: SparkSession, lines: DataFrame) -> DataFrame:
    lines.createOrReplaceTempView("bench_lines")
    return spark.sql("""
        WITH daily AS (SELECT sale_date, sum(sale_dollars) AS sale_dollars FROM bench_lines
                       WHERE sale_date >= date_sub(DATE'1998-01-01', 27) GROUP BY 1),
        ma AS (SELECT d.sale_date, (SELECT avg(p.sale_dollars) FROM daily p
               WHERE p.sale_date BETWEEN date_sub(d.sale_date, 27) AND d.sale_date) AS mean
               FROM daily d),
        points AS (SELECT sale_date, mean, datediff(sale_date, min(sale_date) OVER ()) AS x
                   FROM ma WHERE sale_date >= DATE'1998-01-01'),
        model AS (SELECT regr_slope(mean, x) AS slope, regr_intercept(mean, x) AS intercept FROM points)
        SELECT sale_date, round(mean, 0) AS moving_avg, round(intercept + slope * x, 0) AS trend_line
        FROM points CROSS JOIN model ORDER BY sale_date""")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {
        name: timed(lambda name=name: run(QUERIES[name](spark, sf_dir)), repeats)
        for name in HEADLINES
    }

    # the reports on the stored fact table, where folders can be pruned
    start = time.perf_counter()
    table = stored_sales(spark, sf_dir)
    first_load = time.perf_counter() - start
    facts = table.read()
    rows = facts.count()
    start_day = date(1998, 1, 1)
    on_table = {
        "ttm_sales_by_category": (
            lambda: reports.ttm_sales_by_category(facts, anchor=table.last_date()),
            lambda: literal_category(spark, facts)),
        "daily_ma_trend": (
            lambda: reports.daily_trend(facts, visible_start=start_day),
            lambda: literal_trend(spark, facts)),
    }
    compared = {
        name: {"rewrite": timed(lambda: run(rewrite()), repeats),
               "literal": timed(lambda: run(literal()), repeats)}
        for name, (rewrite, literal) in on_table.items()
    }

    # one corrected month: touched months only, against writing the whole table anew
    source = facts.where("sale_year = 2000 AND sale_month = 6").withColumn(
        "sale_dollars", F.col("sale_dollars") + 1)
    start = time.perf_counter()
    changed = table.upsert(source)
    touched = time.perf_counter() - start
    start = time.perf_counter()
    upsert.merge_upsert(facts, source).select(*SALES.fieldNames()).write.partitionBy(
        "sale_year", "sale_month").parquet(fresh_folder(spark, "bench-full"))
    full = time.perf_counter() - start
    compared["merge_upsert_month"] = {"rewrite": round(touched, 3), "literal": round(full, 3)}

    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
        "against_literal_form": compared,
        "fact_rows": rows,
        "first_load_rows_per_sec": round(rows / first_load),
        "upsert_rows_per_sec": round(changed / touched),
    }))
    sys.stdout.flush()


if __name__ == "__main__":
    main()
