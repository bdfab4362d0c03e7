"""The named sales reports.

Each works on sales lines and only reads the columns it names. Lines are always summed
before text is reshaped, windows run or results are sorted.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.dates import first_of_month, month_start, shift_months, today_or
from shelfscan.functions.numbers import exact_sum
from shelfscan.functions.text import dollars, title_case
from shelfscan.operators.filters import between_dates, on_dates, trailing_year
from shelfscan.operators.rolling import (
    dense, rolling_mean_days, rolling_mean_rows, totals_by, with_trend,
)

def whole(amount: Column) -> Column:
    """Rounded to whole units, half away from zero, as DOUBLE."""
    return F.round(amount, 0).cast("double")


def ttm_sales(sales: DataFrame, anchor: date | None = None) -> DataFrame:
    """Trailing-twelve-month sales as dollar text."""
    kept = trailing_year(sales, anchor=anchor)
    return kept.agg(dollars(exact_sum(F.col("sale_dollars"))).alias("ttm_sales"))


def _ttm_by(sales: DataFrame, column: str, name: str, anchor: date | None) -> DataFrame:
    # the title-cased name can merge groups, so it is made from the group names and the
    # groups are summed once more
    groups = trailing_year(sales, anchor=anchor).groupBy(column).agg(
        exact_sum(F.col("sale_dollars")).alias("_sales"))
    return groups.groupBy(title_case(F.col(column)).alias(name)).agg(
        whole(F.sum("_sales")).alias("ttm_sales"))


def ttm_sales_by_category(sales: DataFrame, anchor: date | None = None) -> DataFrame:
    """Trailing-twelve-month sales per product family, largest first."""
    totals = _ttm_by(sales, "liquor_category", "liquor_category", anchor)
    return totals.orderBy(F.col("ttm_sales").desc_nulls_first(), "liquor_category")


def ttm_top_items(sales: DataFrame, n: int | None = None, anchor: date | None = None) -> DataFrame:
    """Trailing-twelve-month sales per item, largest first; ``n`` keeps the top items only."""
    totals = _ttm_by(sales, "item_description", "item", anchor)
    ranked = totals.orderBy(F.col("ttm_sales").desc_nulls_first(), "item")
    return ranked if n is None else ranked.limit(n)


def monthly_sales(
    sales: DataFrame, as_of: date | None = None, months: int = 36, frame: int = 12,
    fill: bool = False,
) -> DataFrame:
    """Monthly sales and their mean over ``frame`` months, from ``months`` months ago to now.

    The scan starts ``frame - 1`` months earlier, so that the first means are full. With ``fill``,
    months without sales between the first and the last month count as zero.
    """
    end = first_of_month(today_or(as_of))
    start = shift_months(end, -months)
    kept = between_dates(sales, shift_months(start, 1 - frame), shift_months(end, 1))
    totals = totals_by(kept, month_start(F.col("sale_date")), "month",
                       _sales=exact_sum(F.col("sale_dollars")))
    if fill:
        totals = dense(totals, "month", "MONTH", "_sales")
    means = rolling_mean_rows(totals, "_sales", "month", frame, "_mean")
    return means.where(F.col("month").between(F.lit(start), F.lit(end))).select(
        F.col("month").alias("sale_date"),
        whole(F.col("_sales")).alias("monthly_sales"),
        whole(F.col("_mean")).alias("ttm_avg_sales"),
    ).orderBy("sale_date")


def daily_totals(sales: DataFrame) -> DataFrame:
    return totals_by(sales, F.col("sale_date"), "sale_date",
                     sale_dollars=exact_sum(F.col("sale_dollars")))


def daily_trend(
    sales: DataFrame,
    visible_start: date = date(2023, 1, 1),
    visible_end: date = date(9999, 12, 31),
    window_days: int = 28,
    mean: Callable[..., DataFrame] = rolling_mean_days,
    fill: bool = False,
) -> DataFrame:
    """Daily moving average over ``window_days`` calendar days with its trend line.

    The line is fitted on the unrounded averages of the visible days; ``x`` counts days from
    the first of them. With ``fill``, days without sales count as zero.
    """
    scan_start = date.fromordinal(visible_start.toordinal() - window_days + 1)
    kept = on_dates(sales, scan_start, visible_end)
    totals = daily_totals(kept)
    if fill:
        totals = dense(totals, "sale_date", "DAY", "sale_dollars")
    means = mean(totals, "sale_dollars", "sale_date", window_days, "moving_avg")
    visible = means.where(
        F.col("moving_avg").isNotNull()
        & F.col("sale_date").between(F.lit(visible_start), F.lit(visible_end)))
    first_day = visible.agg(F.min("sale_date").alias("first")).scalar()
    points = visible.withColumn("x", F.datediff("sale_date", first_day))
    return with_trend(points, "x", "moving_avg", "trend_line").select(
        "sale_date",
        whole(F.col("moving_avg")).alias("moving_avg"),
        whole(F.col("trend_line")).alias("trend_line"),
    ).orderBy("sale_date")


# Display names of report columns.
LABELS = {
    "liquor_category": "Liquor Category",
    "item": "Item",
    "ttm_sales": "TTM Sales",
    "sale_date": "Sale Month",
    "monthly_sales": "Monthly Sales",
    "ttm_avg_sales": "TTM Avg Sales",
}


def with_labels(report: DataFrame, labels: dict[str, str] = LABELS) -> DataFrame:
    """Rename report columns to their display names."""
    return report.withColumnsRenamed({k: v for k, v in labels.items() if k in report.columns})
