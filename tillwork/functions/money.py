"""Exact money arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.model import MONEY_SUM


def money_sum(amount: Column) -> Column:
    return F.sum(amount).cast(MONEY_SUM)


def mean_2(total: Column, n: Column) -> Column:
    """Mean to two places, half away from zero; null when n is 0.

    Divides an exact sum by a count: Spark's avg() of a decimal keeps six places
    only, so rounding it would round twice.
    """
    return F.round(total / F.nullif(n, F.lit(0)), 2).cast("decimal(18,2)")


def percent_2(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole`` to two places; null when whole is 0.

    Both sides have the type of a sum, and whole numbers are divided, so nothing is
    rounded twice.
    """
    part, whole = (c.cast(MONEY_SUM) for c in (part, whole))
    size, of = F.abs(part), F.abs(whole)
    # Hundredths of a percent, half up.
    doubled = F.call_function("div", size * 20_000 + of, F.nullif(of * 2, F.lit(0)))
    sign = F.when((part < 0) != (whole < 0), -1).otherwise(1)
    return (sign * doubled.cast("decimal(18,0)") / 100).cast("decimal(18,2)")
