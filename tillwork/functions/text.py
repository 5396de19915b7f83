"""Text cells of raw feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a cell.
# Spark's plain trim() removes spaces only.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Cell texts that a raw feed uses for "no value".
NULL_WORDS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def cell(value: Column) -> Column:
    """Trimmed text; a missing cell reads as the empty string."""
    return F.btrim(F.coalesce(value, F.lit("")), F.lit(WHITE_SPACE))


def null_words(value: Column) -> Column:
    """Null where the untrimmed cell is one of the words for "no value"."""
    return F.when(~value.isin(*NULL_WORDS), value)


def email_ok(email: Column) -> Column:
    """There is an @, and a dot somewhere after the last @."""
    return email.contains("@") & F.substring_index(email, "@", -1).contains(".")
