"""Date windows and other row filters.

Bounds are resolved to literals first (one aggregate over one column), because literals
reach partition pruning and Parquet row-group statistics; a cross join with a one-row
relation reaches neither.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscan.functions.dates import first_of_month, shift_months

DAY = "sale_date"


def latest_date(rows: DataFrame, day: str = DAY) -> date | None:
    return rows.agg(F.max(day)).first()[0]


def trailing_months(anchor: date, months: int = 12) -> tuple[date, date]:
    """Half-open bounds of the ``months`` calendar months that end with the anchor's month."""
    return shift_months(anchor, 1 - months), shift_months(anchor, 1)


def between_dates(rows: DataFrame, low: date, high: date, day: str = DAY) -> DataFrame:
    """Rows with ``low <= day < high``; adds the month-folder predicate where there is one."""
    return in_periods(rows, (low, high), day=day)


def on_dates(rows: DataFrame, low: date, high: date, day: str = DAY) -> DataFrame:
    """Rows with ``low <= day <= high``, with the month-folder predicate where there is one."""
    kept = rows.where(F.col(day).between(F.lit(low), F.lit(high)))
    return kept.where(_months(low, high)) if _has_months(rows, day) else kept


def _has_months(rows: DataFrame, day: str) -> bool:
    return day == DAY and {"sale_year", "sale_month"} <= set(rows.columns)


def _months(low: date, high: date) -> Column:
    """Predicate on the partition columns that goes with a date range; Spark derives none."""
    number = F.col("sale_year") * 100 + F.col("sale_month")
    return number.between(low.year * 100 + low.month, high.year * 100 + high.month)


def in_periods(rows: DataFrame, *periods: tuple[date, date], day: str = DAY) -> DataFrame:
    """Rows in any of the half-open periods."""
    by_month = _has_months(rows, day)
    tests = []
    for low, high in periods:
        test = (F.col(day) >= F.lit(low)) & (F.col(day) < F.lit(high))
        if by_month:
            test = test & _months(low, date.fromordinal(high.toordinal() - 1))
        tests.append(test)
    return rows.where(reduce(or_, tests))


def trailing_year(rows: DataFrame, months: int = 12, anchor: date | None = None) -> DataFrame:
    """The last ``months`` calendar months up to the month of MAX(sale_date), whole or not."""
    anchor = anchor or latest_date(rows)
    if anchor is None:
        return rows.where(F.lit(False))
    return between_dates(rows, *trailing_months(first_of_month(anchor), months))


def trailing_year_late(rows: DataFrame, months: int = 12, day: str = DAY) -> DataFrame:
    """The same rows with bounds found while the query runs, as scalar subqueries."""
    newest = rows.agg(F.trunc(F.max(day), "MM").alias("month"))
    low = newest.select(F.add_months("month", 1 - months)).scalar()
    high = newest.select(F.add_months("month", 1)).scalar()
    return rows.where((F.col(day) >= low) & (F.col(day) < high))


def in_list(rows: DataFrame, column: str, values: Sequence) -> DataFrame:
    return rows.where(F.col(column).isin(list(values)))


def known(column: Column) -> Column:
    return column.isNotNull()
