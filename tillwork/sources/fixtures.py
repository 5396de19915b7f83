"""The retail tables, and dirty feeds of them, derived from the order-processing test tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.model import PRICE
from tillwork.operators.ordered import row_numbers_split
from tillwork.sources.feeds import POSITION

# Naming the columns spares a job that would read the file footers for them.
_SCHEMAS = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}

# Together these columns identify a line: no two lines agree in all of them.
_LINE_ORDER = [
    "l_orderkey",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
    "l_shipdate",
]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def _header_status() -> Column:
    state = F.col("o_orderstatus")
    return (
        F.when(state == "F", "completed").when(state == "O", "pending").otherwise("cancelled")
    ).alias("status")


def _line_status() -> Column:
    return (
        F.when(F.col("l_returnflag") == "R", "returned").otherwise(_header_status()).alias("status")
    )


def _order_date() -> Column:
    return F.col("o_orderdate").cast("date")


def customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = _table(spark, folder, "customer")
    nation = _table(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit("@example.com")).alias(
            "email"
        ),
        F.col("n_name").alias("city"),
        F.lit(None).cast("date").alias("signup_date"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("title"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").cast(PRICE).alias("price"),
    )


def order_headers(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order, without products."""
    return _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        _order_date().alias("order_date"),
        _header_status(),
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    return _table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("payment_id"),
        F.col("o_orderkey").alias("order_id"),
        _order_date().alias("payment_date"),
        F.col("o_totalprice").cast(PRICE).alias("amount"),
        F.col("o_orderpriority").alias("method"),
    )


def orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per product ordered; an order id may repeat."""
    lines = _table(spark, folder, "lineitem")
    heads = _table(spark, folder, "orders")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _order_date().alias("order_date"),
        _line_status(),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Order and product of each line, as they stand in the line table."""
    return _table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id")
    )


def single_product_orders(spark: SparkSession, folder: str) -> DataFrame:
    """One row per product ordered, each with an order id of its own: 1, 2, 3 ..."""
    # Numbers are given to the lines before the join, which they do not depend on.
    lines = row_numbers_split(
        _table(spark, folder, "lineitem"),
        "order_id",
        key="l_orderkey",
        order_by=_LINE_ORDER,
        finer=F.struct("l_orderkey", "l_linenumber", F.shiftright("l_partkey", 14).alias("parts")),
    )
    heads = _table(spark, folder, "orders")
    return lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "order_id",
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _order_date().alias("order_date"),
        _line_status(),
    )


def customers_raw(spark: SparkSession, folder: str) -> DataFrame:
    """A customer feed as text in order of the key, with faults at fixed remainders of it."""
    customer = _table(spark, folder, "customer")
    nation = _table(spark, folder, "nation")
    key = F.col("c_custkey")
    text = key.cast("string")
    spot = key % 20
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        text.alias("customer_id"),
        F.when(spot == 3, "").otherwise(F.col("c_name")).alias("full_name"),
        F.when(spot == 5, "")
        .when(spot == 7, F.concat(F.lit("c"), text, F.lit("example.com")))
        .when(spot == 9, F.concat(F.lit("C"), (key - 1).cast("string"), F.lit("@Example.com")))
        .otherwise(F.concat(F.lit("c"), text, F.lit("@example.com")))
        .alias("email"),
        F.when(key % 40 == 8, "   ").otherwise(F.col("n_name")).alias("city"),
        F.when(spot == 11, "not-a-date")
        .when(spot == 13, F.lit(None).cast("string"))
        .when(spot == 14, "2024")
        .when(spot == 15, "2024-1-5")
        .otherwise("2024-01-15")
        .alias("signup_date"),
        key.alias(POSITION),
    )


def products_raw(spark: SparkSession, folder: str) -> DataFrame:
    """A product feed as text, with faults at fixed remainders of the key."""
    key = F.col("p_partkey")
    return _table(spark, folder, "part").select(
        key.cast("string").alias("product_id"),
        F.when(key % 20 == 3, "").otherwise(F.col("p_name")).alias("title"),
        F.when(key % 20 == 5, "").otherwise(F.col("p_type")).alias("category"),
        F.when(key % 25 == 7, "N/A")
        .when(key % 33 == 8, "-5.00")
        .when(key % 50 == 9, "0")
        .otherwise(F.col("p_retailprice").cast(PRICE).cast("string"))
        .alias("price"),
        key.alias(POSITION),
    )


def orders_raw(spark: SparkSession, folder: str) -> DataFrame:
    """An order feed as text, with faults at fixed remainders of the key."""
    parts = _table(spark, folder, "part").agg(F.count(F.lit(1))).scalar()
    key = F.col("o_orderkey")
    spot = key % 100
    return _table(spark, folder, "orders").select(
        key.cast("string").alias("order_id"),
        F.when(key % 25 == 4, "-99999999")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("customer_id"),
        F.when(key % 25 == 6, "-88888888")
        .otherwise((key % parts).cast("string"))
        .alias("product_id"),
        F.when(spot.isin(1, 2, 3), "0")
        .when(spot.isin(4, 5), "-2")
        .when(spot.isin(6, 7), "two")
        .otherwise((1 + key % 5).cast("string"))
        .alias("quantity"),
        F.when(key % 33 == 10, "2025-13-40")
        .otherwise(_order_date().cast("string"))
        .alias("order_date"),
        F.when(key % 20 == 9, "shipped").otherwise(_header_status()).alias("status"),
        key.alias(POSITION),
    )


def payments_raw(spark: SparkSession, folder: str) -> DataFrame:
    """A payment feed as text, with faults at fixed remainders of the key."""
    key = F.col("o_orderkey")
    text, spot = key.cast("string"), key % 20
    method = F.col("o_orderpriority")
    return _table(spark, folder, "orders").select(
        text.alias("payment_id"),
        F.when(key % 25 == 4, "-99999999").when(key % 100 == 31, "x").otherwise(text).alias("order_id"),
        F.when(key % 33 == 10, "2025-13-40")
        .otherwise(_order_date().cast("string"))
        .alias("payment_date"),
        F.when(spot == 3, "0")
        .when(spot == 5, "ten")
        .when(key % 50 == 7, "0.004")
        .otherwise(F.col("o_totalprice").cast(PRICE).cast("string"))
        .alias("amount"),
        F.when(spot == 9, "").when(key % 100 == 41, F.repeat(method, F.lit(20))).otherwise(method).alias("method"),
        key.alias(POSITION),
    )


def broken_parents_raw(spark: SparkSession, folder: str) -> DataFrame:
    """An order feed some of whose customer and product ids are no whole numbers."""
    raw = orders_raw(spark, folder)
    key = F.col(POSITION)
    return raw.withColumns(
        {
            "customer_id": F.when(key % 10 == 1, "")
            .when(key % 10 == 2, F.concat(F.lit("c"), "customer_id"))
            .when(key % 10 == 3, F.concat("customer_id", F.lit(".5")))
            .otherwise(F.concat(F.lit(" "), "customer_id")),
            "product_id": F.when(key % 15 == 1, "none").otherwise(F.col("product_id")),
        }
    )


def _twice(df: DataFrame, key: str) -> DataFrame:
    """Rows at fixed remainders of the key come twice, with ``_copy`` 0 and 1."""
    copies = F.when(F.col(key) % 50 == 21, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies))


def _text_id(key: str) -> Column:
    """Now and then an id that is no whole number."""
    text = F.col(key).cast("string")
    return F.when(F.col(key) % 100 == 31, F.concat(F.lit("x"), text)).otherwise(text)


def repeated_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Feeds whose faults are repeated or broken ids, texts that are too long, tiny prices."""
    again = F.col("_copy") == 1
    customer, part = (_table(spark, folder, t) for t in ("customer", "part"))
    c, p, o = F.col("c_custkey"), F.col("p_partkey"), F.col("o_orderkey")
    long_name = F.when(c % 100 == 41, F.repeat("c_name", F.lit(6))).otherwise(F.col("c_name"))
    long_title = F.when(p % 100 == 41, F.repeat("p_name", F.lit(160))).otherwise(F.col("p_name"))
    return {
        "customers": _twice(customer, "c_custkey").select(
            _text_id("c_custkey").alias("customer_id"),
            F.when(again, F.concat("c_name", F.lit(" again"))).otherwise(long_name).alias("full_name"),
            F.concat(F.lit("c"), c.cast("string"), F.lit("@"), "_copy", F.lit(".org")).alias("email"),
            F.lit("Town").alias("city"),
            F.lit(None).cast("string").alias("signup_date"),
            (2 * c + F.col("_copy")).alias(POSITION),
        ),
        "products": _twice(part, "p_partkey").select(
            _text_id("p_partkey").alias("product_id"),
            F.when(again, F.concat("p_name", F.lit(" again"))).otherwise(long_title).alias("title"),
            F.lit("things").alias("category"),
            F.when(p % 100 == 51, "0.004").otherwise("1.50").alias("price"),
            (2 * p + F.col("_copy")).alias(POSITION),
        ),
        "orders": _twice(_table(spark, folder, "orders"), "o_orderkey").select(
            _text_id("o_orderkey").alias("order_id"),
            F.col("o_custkey").cast("string").alias("customer_id"),
            F.col("o_custkey").cast("string").alias("product_id"),
            F.when(again, "9").otherwise("1").alias("quantity"),
            _order_date().cast("string").alias("order_date"),
            F.lit("pending").alias("status"),
            (2 * o + F.col("_copy")).alias(POSITION),
        ),
    }
