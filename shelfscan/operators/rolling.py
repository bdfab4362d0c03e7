"""Moving averages and trend lines over totals per day, week or month.

The windows here have no partition key. They run on totals, whose number is bounded by the
calendar, never on sales lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def totals_by(rows: DataFrame, period: Column, name: str, **sums: Column) -> DataFrame:
    """One row per period with the given aggregates."""
    return rows.groupBy(period.alias(name)).agg(*[agg.alias(alias) for alias, agg in sums.items()])


def dense(totals: DataFrame, period: str, step: str, *values: str) -> DataFrame:
    """Totals with a row for every period from the first to the last, zero where there was none.

    ``step`` is ``MONTH`` or ``DAY``. Averages over such totals divide by the calendar's periods.
    """
    first, last = (totals.agg(f(period)).scalar() for f in (F.min, F.max))
    every = totals.sparkSession.range(1).select(first.alias("_first"), last.alias("_last")).where(
        "_first IS NOT NULL").select(F.explode(F.sequence(
            "_first", "_last", F.expr(f"INTERVAL 1 {step}"))).alias(period))
    return every.join(totals, period, "left").fillna(0, list(values))


def _mean(value: str, frame) -> Column:
    """Mean in a frame as exact sum over count, independent of the order of additions."""
    return F.sum(value).over(frame).cast("double") / F.count(value).over(frame)


def rolling_mean_rows(totals: DataFrame, value: str, order: str, rows: int, name: str) -> DataFrame:
    """Mean of the current and the preceding ``rows - 1`` rows (rows that exist)."""
    frame = Window.orderBy(order).rowsBetween(1 - rows, Window.currentRow)
    return totals.withColumn(name, _mean(value, frame))


def rolling_mean_days(totals: DataFrame, value: str, day: str, days: int, name: str) -> DataFrame:
    """Mean of the totals in the ``days`` calendar days that end with the row's day."""
    number = F.unix_date(F.col(day))
    frame = Window.orderBy(number).rangeBetween(1 - days, Window.currentRow)
    return totals.withColumn(name, _mean(value, frame))


def rolling_mean_days_joined(
    totals: DataFrame, value: str, day: str, days: int, name: str,
) -> DataFrame:
    """The same mean as an equi-join: each total is sent to the ``days`` days it counts for.

    No window, so it also works partitioned; each total is repeated ``days`` times.
    """
    sent = totals.select(
        F.explode(F.sequence(F.col(day), F.date_add(F.col(day), days - 1))).alias(day),
        F.col(value).alias("_value"))
    means = sent.groupBy(day).agg(
        (F.sum("_value").cast("double") / F.count("_value")).alias(name))
    return totals.join(means, day)


def with_trend(points: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """Add the least-squares line of ``y`` on ``x`` with its slope and intercept.

    The two coefficients come from one aggregate and are read as scalar subqueries, which
    takes the place of a cross join with a one-row model.
    """
    model = points.agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))
    slope, intercept = model.select("slope").scalar(), model.select("intercept").scalar()
    return points.select(
        "*", slope.alias("slope"), intercept.alias("intercept"),
        (intercept + slope * F.col(x)).alias(name))
