"""Business questions over sales lines.

"Latest" is the month, quarter or week of the newest sale date. Every question sums the
lines once, with conditional sums for the periods it compares, and works on those totals.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscan.functions.dates import first_of_month, month_start, shift_months, week_start
from shelfscan.functions.numbers import ratio
from shelfscan.operators.filters import between_dates, in_periods, latest_date
from shelfscan.operators.keyed import first_per_key
from shelfscan.operators.metrics import sum_part
from shelfscan.operators.rolling import with_trend
from shelfscan.plans.reports import whole

FAMILY = "liquor_category"
ITEM = "item_description"


def _share(value: Column) -> Column:
    return F.round(value, 6)


def _in(low: date, high: date) -> Column:
    return (F.col("sale_date") >= F.lit(low)) & (F.col("sale_date") < F.lit(high))


def _part_in(part: str, low: date, high: date) -> Column:
    """Exact sum of a part over the lines of a period; zero when there are none."""
    return F.coalesce(sum_part(part, _in(low, high)), F.lit(0))


def _newest(sales: DataFrame, anchor: date | None) -> date:
    anchor = anchor or latest_date(sales)
    if anchor is None:
        raise ValueError("there are no dated sales")
    return anchor


def _change(now: str, before: str) -> list[Column]:
    delta = F.col(now) - F.col(before)
    return [
        whole(F.col(now)).alias(now), whole(F.col(before)).alias(before),
        whole(delta).alias("change"), _share(ratio(delta, F.col(before))).alias("pct_change"),
    ]


def month_yoy(sales: DataFrame, top: int = 3, anchor: date | None = None) -> DataFrame:
    """Latest month against the same month a year ago: the total, then the leading families."""
    month = first_of_month(_newest(sales, anchor))
    now, before = (month, shift_months(month, 1)), (shift_months(month, -12), shift_months(month, -11))
    families = in_periods(sales, now, before).groupBy(FAMILY).agg(
        _part_in("sales", *now).alias("latest_sales"),
        _part_in("sales", *before).alias("prior_sales"))
    delta = F.col("latest_sales") - F.col("prior_sales")
    overall = families.agg(
        F.lit(0).alias("place"), F.lit("TOTAL").alias("family"),
        F.sum("latest_sales").alias("latest_sales"), F.sum("prior_sales").alias("prior_sales"))
    place = F.row_number().over(Window.orderBy(delta.desc(), FAMILY))
    leaders = families.select(
        place.alias("place"), F.col(FAMILY).alias("family"), "latest_sales", "prior_sales",
    ).where(F.col("place") <= top)
    return overall.unionByName(leaders).select(
        "place", "family", *_change("latest_sales", "prior_sales")).orderBy("place")


def top_items_with_mom(sales: DataFrame, n: int = 10, anchor: date | None = None) -> DataFrame:
    """Top items by three-month sales with the latest month's change on the month before."""
    month = first_of_month(_newest(sales, anchor))
    end = shift_months(month, 1)
    start = shift_months(month, -2)
    items = between_dates(sales, start, end).groupBy(ITEM).agg(
        _part_in("sales", start, end).alias("_t3m"),
        _part_in("sales", month, end).alias("_latest"),
        _part_in("sales", shift_months(month, -1), month).alias("_prior"))
    return items.orderBy(F.col("_t3m").desc(), ITEM).limit(n).select(
        F.col(ITEM).alias("item"),
        whole(F.col("_t3m")).alias("t3m_sales"),
        whole(F.col("_latest")).alias("latest_month_sales"),
        whole(F.col("_prior")).alias("prior_month_sales"),
        _share(ratio(F.col("_latest") - F.col("_prior"), F.col("_prior"))).alias("mom_change"))


def weekly_outliers(
    sales: DataFrame, weeks: int = 26, deviations: float = 2.0, anchor: date | None = None,
) -> DataFrame:
    """Sales of the last weeks with a trend line; marks weeks far above the mean."""
    newest = _newest(sales, anchor)
    last = newest - timedelta(days=newest.weekday())
    first = last - timedelta(weeks=weeks - 1)
    totals = between_dates(sales, first, last + timedelta(days=7)).groupBy(
        week_start(F.col("sale_date")).alias("week")).agg(
        sum_part("sales").cast("double").alias("sales"))
    points = totals.withColumn("x", F.floor(F.datediff("week", F.lit(first)) / 7).cast("int"))
    limit = points.agg(
        (F.avg("sales") + deviations * F.stddev_samp("sales")).alias("limit")).scalar()
    return with_trend(points, "x", "sales", "trend").select(
        "week", "x", whole(F.col("sales")).alias("sales"), whole(F.col("trend")).alias("trend"),
        F.round("slope", 2).alias("slope"), F.round("intercept", 2).alias("intercept"),
        (F.col("sales") > limit).alias("is_outlier")).orderBy("week")


def county_growth(sales: DataFrame, anchor: date | None = None) -> DataFrame:
    """Bottles of the last twelve months against the twelve before, with the leading family."""
    end = shift_months(first_of_month(_newest(sales, anchor)), 1)
    start, earlier = shift_months(end, -12), shift_months(end, -24)
    pairs = between_dates(sales, earlier, end).groupBy("county", FAMILY).agg(
        _part_in("bottles", start, end).alias("_now"),
        _part_in("bottles", earlier, start).alias("_before"))
    counties = pairs.groupBy("county").agg(
        F.sum("_now").alias("ttm_bottles"), F.sum("_before").alias("prior_bottles"))
    leading = first_per_key(
        pairs, ["county"], [F.col("_now").desc(), F.col(FAMILY)],
    ).select(F.col("county").alias("_county"), F.col(FAMILY).alias("leading_family"))
    growth = ratio(F.col("ttm_bottles") - F.col("prior_bottles"), F.col("prior_bottles"))
    return counties.join(leading, F.col("county").eqNullSafe(F.col("_county"))).select(
        "county", "ttm_bottles", "prior_bottles", _share(growth).alias("growth"), "leading_family",
    ).orderBy(F.col("growth").desc_nulls_last(), "county")


def family_shares(sales: DataFrame, anchor: date | None = None) -> DataFrame:
    """Twelve-month sales per family, share of the total and the last month's change."""
    month = first_of_month(_newest(sales, anchor))
    end, start, before = shift_months(month, 1), shift_months(month, -11), shift_months(month, -1)
    families = between_dates(sales, start, end).groupBy(FAMILY).agg(
        _part_in("sales", start, end).alias("_ttm"),
        _part_in("sales", month, end).alias("_latest"),
        _part_in("sales", before, month).alias("_prior"))
    everything = families.agg(F.sum("_ttm")).scalar()
    return families.select(
        F.col(FAMILY).alias("family"),
        whole(F.col("_ttm")).alias("ttm_sales"),
        _share(ratio(F.col("_ttm"), everything)).alias("share"),
        whole(F.col("_latest")).alias("latest_month_sales"),
        whole(F.col("_prior")).alias("prior_month_sales"),
        whole(F.col("_latest") - F.col("_prior")).alias("change"),
    ).orderBy(F.col("ttm_sales").desc(), "family")


def quarter_margin(sales: DataFrame, anchor: date | None = None) -> DataFrame:
    """Gross margin per family in the latest quarter against the same quarter a year ago."""
    newest = _newest(sales, anchor)
    quarter = date(newest.year, (newest.month - 1) // 3 * 3 + 1, 1)
    now = (quarter, shift_months(quarter, 3))
    before = (shift_months(quarter, -12), shift_months(quarter, -9))
    families = in_periods(sales, now, before).groupBy(FAMILY).agg(
        _part_in("margin", *now).alias("latest_margin"),
        _part_in("margin", *before).alias("prior_margin"))
    return families.select(
        F.col(FAMILY).alias("family"), *_change("latest_margin", "prior_margin"),
    ).orderBy(F.col("latest_margin").desc(), "family")


def top_margin_items(sales: DataFrame, n: int = 10, anchor: date | None = None) -> DataFrame:
    """Top items by margin over three months, with the margin rate now and three months before."""
    end = shift_months(first_of_month(_newest(sales, anchor)), 1)
    start, earlier = shift_months(end, -3), shift_months(end, -6)
    items = between_dates(sales, earlier, end).groupBy(ITEM).agg(
        _part_in("margin", start, end).alias("_margin"),
        _part_in("sales", start, end).alias("_sales"),
        _part_in("margin", earlier, start).alias("_margin_before"),
        _part_in("sales", earlier, start).alias("_sales_before"))
    return items.orderBy(F.col("_margin").desc(), ITEM).limit(n).select(
        F.col(ITEM).alias("item"),
        whole(F.col("_margin")).alias("margin"),
        _share(ratio(F.col("_margin"), F.col("_sales"))).alias("margin_rate"),
        _share(ratio(F.col("_margin_before"), F.col("_sales_before"))).alias("prior_margin_rate"))


def margin_trend(
    sales: DataFrame, months: int = 12, drop: float = 0.02, anchor: date | None = None,
) -> DataFrame:
    """Monthly margin and margin rate with a trend line; marks sharp drops of the rate."""
    month = first_of_month(_newest(sales, anchor))
    start, end = shift_months(month, 1 - months), shift_months(month, 1)
    totals = between_dates(sales, start, end).groupBy(
        month_start(F.col("sale_date")).alias("month")).agg(
        sum_part("margin").alias("_margin"), sum_part("sales").alias("_sales"))
    first = start.year * 12 + start.month
    points = totals.select(
        "month", "_margin", ratio(F.col("_margin"), F.col("_sales")).alias("_rate"),
        (F.year("month") * 12 + F.month("month") - first).alias("x"))
    fall = F.col("_rate") - F.lag("_rate").over(Window.orderBy("month"))
    return with_trend(points, "x", "_rate", "_trend").select(
        "month", whole(F.col("_margin")).alias("margin"), _share(F.col("_rate")).alias("margin_rate"),
        _share(F.col("_trend")).alias("trend"),
        F.coalesce(fall < -drop, F.lit(False)).alias("is_sharp_drop")).orderBy("month")


def latest_month_leaders(sales: DataFrame, top: int = 3, anchor: date | None = None) -> DataFrame:
    """Sales of the latest month: the total, then the leading families."""
    month = first_of_month(_newest(sales, anchor))
    families = between_dates(sales, month, shift_months(month, 1)).groupBy(FAMILY).agg(
        sum_part("sales").alias("_sales"))
    place = F.row_number().over(Window.orderBy(F.col("_sales").desc(), FAMILY))
    leaders = families.select(
        place.alias("place"), F.col(FAMILY).alias("family"), "_sales").where(F.col("place") <= top)
    overall = families.agg(
        F.lit(0).alias("place"), F.lit("TOTAL").alias("family"), F.sum("_sales").alias("_sales"))
    return overall.unionByName(leaders).select(
        "place", "family", whole(F.col("_sales")).alias("sales")).orderBy("place")


#: The questions by name.
QUESTIONS: dict[str, Callable[..., DataFrame]] = {
    question.__name__: question for question in (
        month_yoy, top_items_with_mom, weekly_outliers, county_growth, family_shares,
        quarter_margin, top_margin_items, margin_trend, latest_month_leaders)}
