"""Date dimension, generated for a range of days."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscan.schemas import CALENDAR
from shelfscan.session import empty_frame

# dayofweek() counts from Sunday = 1
MONDAY, THURSDAY, FRIDAY, SATURDAY = 2, 5, 6, 7

# Holidays on a day of the month: name, month, day, first year.
FIXED_HOLIDAYS = [
    ("New Year's Day", 1, 1, 1871),
    ("Juneteenth National Independence Day", 6, 19, 2021),
    ("Independence Day", 7, 4, 1871),
    ("Veterans Day", 11, 11, 1938),
    ("Christmas Day", 12, 25, 1871),
]
# Holidays on a weekday of the month: name, month, weekday, earliest day of
# month, first year. The weekday falls into the seven days from the earliest day on.
FLOATING_HOLIDAYS = [
    ("Martin Luther King Jr. Day", 1, MONDAY, 15, 1986),
    ("Washington's Birthday", 2, MONDAY, 15, 1971),
    ("Memorial Day", 5, MONDAY, 25, 1971),
    ("Labor Day", 9, MONDAY, 1, 1894),
    ("Columbus Day", 10, MONDAY, 8, 1971),
    ("Thanksgiving Day", 11, THURSDAY, 22, 1942),
]


def us_holiday(day: str) -> Column:
    """Name of the US holiday on a day (a column name), or NULL.

    A fixed holiday on a weekend is also observed on the next Monday or the Friday before.
    """
    def fixed(on: str, month: int, number: int, since: int) -> str:
        return f"month({on}) = {month} AND day({on}) = {number} AND year({on}) >= {since}"

    branches = [
        (fixed(day, month, number, since), name) for name, month, number, since in FIXED_HOLIDAYS]
    branches += [
        (f"month({day}) = {month} AND dayofweek({day}) = {weekday} AND year({day}) >= {since} "
         f"AND day({day}) BETWEEN {earliest} AND {earliest + 6}", name)
        for name, month, weekday, earliest, since in FLOATING_HOLIDAYS]
    for name, month, number, since in FIXED_HOLIDAYS:
        before, after = f"date_sub({day}, 1)", f"date_add({day}, 1)"
        branches += [
            (f"dayofweek({day}) = {MONDAY} AND {fixed(before, month, number, since)}", f"{name} (observed)"),
            (f"dayofweek({day}) = {FRIDAY} AND {fixed(after, month, number, since)}", f"{name} (observed)")]
    return F.expr("CASE " + " ".join(
        f'WHEN {condition} THEN "{name}"' for condition, name in branches) + " END")


def _calendar_columns() -> dict[str, str]:
    """Calendar column to SQL expression over ``_day`` and ``_holiday``."""
    return {
        "datekey": "year(_day) * 10000 + month(_day) * 100 + day(_day)",
        "date": "_day",
        "dayofweek": "date_format(_day, 'EEEE')",
        "dayofweek_short": "date_format(_day, 'EEE')",
        "month": "date_format(_day, 'MMMM')",
        "year": "year(_day)",
        "yearmonthnum": "year(_day) * 100 + month(_day)",
        "monthyear": "date_format(_day, 'MMMyyyy')",
        "daynuminweek": "dayofweek(_day)",
        "daynuminmonth": "day(_day)",
        "daynuminyear": "dayofyear(_day)",
        "monthnuminyear": "month(_day)",
        "iso_year": "CAST(extract(YEAROFWEEK FROM _day) AS INT)",
        "iso_weeknuminyear": "weekofyear(_day)",
        "is_last_day_in_week": f"dayofweek(_day) = {SATURDAY}",
        "is_last_day_in_month": "_day = last_day(_day)",
        "is_holiday": "_holiday IS NOT NULL",
        "is_weekday": f"dayofweek(_day) BETWEEN {MONDAY} AND {FRIDAY}",
        "is_holiday_us": "_holiday IS NOT NULL",
        "holiday_name_us": "_holiday",
    }


def build_calendar(spark: SparkSession, low: date, high: date) -> DataFrame:
    """One row per day from ``low`` to ``high``, both included."""
    days = spark.range((high - low).days + 1).select(
        F.date_add(F.lit(low), F.col("id").cast("int")).alias("_day"))
    built = _calendar_columns()
    return days.select("_day", us_holiday("_day").alias("_holiday")).selectExpr(
        *[f"{built[name]} AS {name}" for name in CALENDAR.fieldNames()])


def calendar_of(sales: DataFrame, day: str = "sale_date") -> DataFrame:
    """Calendar of whole years around the dates of a relation."""
    first, last = sales.agg(F.min(day), F.max(day)).first()
    if first is None:
        return empty_frame(sales.sparkSession, CALENDAR)
    return build_calendar(sales.sparkSession, date(first.year, 1, 1), date(last.year, 12, 31))
