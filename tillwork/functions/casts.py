"""Casts of feed text that give null, never an error, when the text does not fit."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillwork.model import PRICE

_WHOLE = r"^[+-]?[0-9]+$"
_NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_DATE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"


def whole_number(text: Column, to: str = "bigint") -> Column:
    """A whole number; ``2.7`` does not pass as 2."""
    return F.when(text.rlike(_WHOLE), text).try_cast(to)


def number(text: Column) -> Column:
    """A double, for sign checks only; money is cast by :func:`price`."""
    return F.when(text.rlike(_NUMBER), text).try_cast("double")


def price(text: Column) -> Column:
    """An exact two-place amount; null when it is no number or too large."""
    return F.when(text.rlike(_NUMBER), text).try_cast(PRICE)


def strict_date(text: Column) -> Column:
    """A ``year-month-day`` date; one-digit months and days pass, times and bare years do not."""
    shaped = text.rlike(_DATE) & ~text.startswith("0000")
    return F.when(shaped, text).try_cast("date")
