"""Calendar helpers. The ones on ``date`` run on the driver and give literal bounds."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def week_start(day: Column) -> Column:
    """Monday of the week, as a DATE."""
    return F.trunc(day, "WEEK")


def first_of_month(day: date) -> date:
    return day.replace(day=1)


def shift_months(day: date, months: int) -> date:
    """First day of the month that lies ``months`` away."""
    serial = day.year * 12 + day.month - 1 + months
    return date(serial // 12, serial % 12 + 1, 1)


def last_full_month(as_of: date) -> tuple[date, date]:
    """First and last day of the month before the one of ``as_of``."""
    this_month = first_of_month(as_of)
    return shift_months(as_of, -1), this_month - timedelta(days=1)


def today_or(as_of: date | None) -> date:
    """``as_of``, or the current day in the time zone of the session."""
    if as_of is not None:
        return as_of
    session = SparkSession.getActiveSession()
    return session.sql("SELECT current_date()").first()[0] if session else date.today()
