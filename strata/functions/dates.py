"""Period and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def period_of(col: Column) -> Column:
    """First day of the month as text, ``YYYY-MM-01``; NULL stays NULL."""
    text = col.cast("string")
    return F.concat(F.substring(text, 1, 7), F.lit("-01"))


def time_key_of(date: Column) -> Column:
    """The calendar day as the number YYYYMMDD."""
    return (F.year(date) * 10000 + F.month(date) * 100 + F.dayofmonth(date)).cast("bigint")


def calendar_columns(date: Column, fiscal_start_month: int = 1) -> dict[str, Column]:
    """Attributes of a calendar day. Weeks and weekdays follow ISO 8601 (Monday is 1).

    A fiscal year is named after the calendar year in which it ends.
    """
    fiscal = F.add_months(date, (13 - fiscal_start_month) % 12)
    weekday = F.weekday(date) + 1
    return {
        "time_key": time_key_of(date),
        "date_key": date,
        "year": F.year(date),
        "quarter": F.quarter(date),
        "month": F.month(date),
        "month_name": F.date_format(date, "MMMM"),
        "week_of_year": F.weekofyear(date),
        "day_of_week": weekday,
        "day_name": F.date_format(date, "EEEE"),
        "is_weekend": weekday >= 6,
        "fiscal_year": F.year(fiscal),
        "fiscal_quarter": F.quarter(fiscal),
        "period": period_of(date),
    }
