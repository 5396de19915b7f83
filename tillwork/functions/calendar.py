"""Calendar parts and month labels of a date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    """The date as the whole number YYYYMMDD."""
    # Whole-number arithmetic: formatting every date as text costs far more.
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def day_of_key(key: Column) -> Column:
    """The date that a whole number YYYYMMDD stands for."""
    month = F.pmod(F.floor(key / 100), F.lit(100))
    return F.make_date(F.floor(key / 10_000), month, F.pmod(key, F.lit(100)))


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_text(day: Column) -> Column:
    """``2025-09``: sorts as text in time order."""
    return F.date_format(day, "yyyy-MM")


def month_title(day: Column) -> Column:
    """``Sep 2025``: for display; does not sort in time order."""
    return F.date_format(day, "MMM yyyy")


def calendar_parts(day: Column) -> list[Column]:
    """Columns of the date dimension; weeks start on Monday, which is day 1."""
    weekday = F.weekday(day)
    return [
        date_key(day).alias("date_key"),
        day.alias("full_date"),
        F.year(day).cast("smallint").alias("year"),
        F.quarter(day).cast("smallint").alias("quarter"),
        F.month(day).cast("smallint").alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).cast("smallint").alias("day"),
        (weekday + 1).cast("smallint").alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 5).alias("is_weekend"),
    ]
