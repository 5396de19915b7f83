from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.functions.calendar import calendar_parts, month_text, month_title
from tillwork.functions.casts import number, price, strict_date, whole_number
from tillwork.functions.money import mean_2, percent_2
from tillwork.functions.text import NULL_WORDS, cell, email_ok, null_words


def _column(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_cell_trims_all_white_space_and_fills_nulls(spark):
    values = [" a b ", "\t\r\nx ", "　 ", None, ""]
    assert _column(spark, values, cell) == ["a b", "x", "", "", ""]


def test_null_words_match_whole_untrimmed_cells(spark):
    assert _column(spark, NULL_WORDS, null_words) == [None] * len(NULL_WORDS)
    assert _column(spark, [" N/A", "nano", "0"], null_words) == [" N/A", "nano", "0"]


def test_email_needs_a_dot_after_the_last_at(spark):
    values = ["a@b.c", "a.b@c", "@.", "a@b.c@d", "a@b@c.d", "ab.c", ""]
    assert _column(spark, values, email_ok) == [True, False, True, False, True, False, False]


def test_whole_numbers(spark):
    values = ["7", "-3", "+4", "2.7", "two", "", "1e3", "9223372036854775808", None]
    assert _column(spark, values, whole_number) == [7, -3, 4] + [None] * 6
    assert _column(spark, ["2147483648"], lambda c: whole_number(c, "int")) == [None]


def test_prices(spark):
    values = ["9.995", "1e2", ".5", "5.", "1.0d", "NaN", "Infinity", "N/A", "123456789.00"]
    expected = [Decimal("10.00"), Decimal("100.00"), Decimal("0.50"), Decimal("5.00")]
    assert _column(spark, values, price) == expected + [None] * 5
    assert _column(spark, ["-2.5", "inf", "0x1p3"], number) == [-2.5, None, None]


def test_strict_dates(spark):
    good = {"2024-02-29": date(2024, 2, 29), "2025-1-5": date(2025, 1, 5)}
    bad = ["2024", "2024-01", "2025-13-40", "2023-02-29", "2024-01-05T10:00:00", "0000-01-01"]
    bad += ["not-a-date", "24-01-05", "2024/01/05", "", None]
    assert _column(spark, [*good, *bad], strict_date) == [*good.values(), *[None] * len(bad)]


def test_calendar(spark):
    df = spark.sql("SELECT date'2026-03-01' AS d UNION ALL SELECT date'2025-09-08' ORDER BY d")
    assert tuples(df, *calendar_parts(F.col("d"))) == [
        (20250908, date(2025, 9, 8), 2025, 3, 9, "September", 8, 1, "Monday", False),
        (20260301, date(2026, 3, 1), 2026, 1, 3, "March", 1, 7, "Sunday", True),
    ]
    labels = tuples(df, month_text(F.col("d")), month_title(F.col("d")))
    assert labels == [("2025-09", "Sep 2025"), ("2026-03", "Mar 2026")]


def test_rounding_is_half_away_from_zero_and_zero_divides_to_null(spark):
    rows = [("10.05", 2), ("0.01", 2), ("10.00", 3), ("5.00", 0)]
    df = spark.createDataFrame(rows, "s string, n bigint").withColumn(
        "s", F.col("s").cast("decimal(28,2)")
    )
    expected = [Decimal("5.03"), Decimal("0.01"), Decimal("3.33"), None]
    assert [r[0] for r in df.select(mean_2(F.col("s"), F.col("n"))).collect()] == expected
    parts = spark.createDataFrame([(1, 8), (-1, 16), (1, 0)], "p bigint, w bigint")
    assert [r[0] for r in parts.select(percent_2(F.col("p"), F.col("w"))).collect()] == [
        Decimal("12.50"),
        Decimal("-6.25"),
        None,
    ]
    # -0.125 % rounds away from zero.
    tie = spark.createDataFrame([(-1, 800)], "p bigint, w bigint")
    assert tie.select(percent_2(F.col("p"), F.col("w"))).first()[0] == Decimal("-0.13")


def test_percentages_of_sums_of_any_size(spark):
    rows = [(10**24, 3 * 10**24), (-(10**20), 10**25), (1, 3), (2, 3), (0, 5), (None, 5)]
    rows = [tuple(None if x is None else Decimal(x) for x in r) for r in rows]
    df = spark.createDataFrame(rows, "p decimal(28,2), w decimal(28,2)")
    got = [r[0] for r in df.select(percent_2(F.col("p"), F.col("w"))).collect()]
    assert got == [Decimal(x) for x in ("33.33", "0.00", "33.33", "66.67", "0.00")] + [None]
