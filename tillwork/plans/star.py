"""The star schema: three dimensions, one fact, and the checks before it is published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.functions.calendar import calendar_parts, date_key, day_of_key
from tillwork.model import LINE_AMOUNT, PRICE, Star
from tillwork.operators.ordered import id_levels, row_numbers


class IntegrityError(Exception):
    """The tables must not be published."""


def dim_customers(customers: DataFrame) -> DataFrame:
    """The key is the customer's own id, so it never moves between loads."""
    return customers.select(
        F.col("customer_id").alias("customer_key"),
        "customer_id",
        "full_name",
        "email",
        "city",
        "signup_date",
    )


def dim_products(products: DataFrame) -> DataFrame:
    """The key is the product's own id, so it never moves between loads."""
    return products.select(
        F.col("product_id").alias("product_key"),
        "product_id",
        "title",
        "category",
        F.col("price").cast(PRICE).alias("price"),
    )


def dim_date(orders: DataFrame) -> DataFrame:
    """Every day from the first to the last order, of any status."""
    span = orders.agg(F.min("order_date").alias("_first"), F.max("order_date").alias("_last"))
    days = span.select(F.explode(F.sequence("_first", "_last")).alias("_day"))
    return days.select(*calendar_parts(F.col("_day")))


def dim_date_of(fact: DataFrame) -> DataFrame:
    """``dim_date`` of the orders in a fact, found by its keys alone."""
    return dim_date(fact.select(day_of_key(F.col("date_key")).alias("order_date")))


def fact_orders(orders: DataFrame, products: DataFrame, *, dense_keys: bool = False) -> DataFrame:
    """One row per order, priced at the current product price.

    A product that does not exist leaves ``product_key`` and ``unit_price`` null, and an
    amount that does not fit leaves ``total_amount`` null; the checks count both.
    The customer key equals the customer id, so no join is needed to find it;
    :func:`unresolved_keys` tells whether the customers exist. ``order_key`` is the
    order id, or with ``dense_keys`` 1, 2, 3 ... in order of the order id.
    """
    if dense_keys:
        # Numbered before the join: the numbers depend on the order id alone.
        keyed = row_numbers(
            orders, "order_key", order_by=["order_id"], levels=id_levels(orders, "order_id")
        )
    else:
        keyed = orders.withColumn("order_key", F.col("order_id"))
    prices = products.select("product_id", F.col("price").cast(PRICE).alias("unit_price"))
    return keyed.join(prices, "product_id", "left").select(
        "order_key",
        "order_id",
        F.col("customer_id").alias("customer_key"),
        F.when(F.col("unit_price").isNotNull(), F.col("product_id")).alias("product_key"),
        date_key(F.col("order_date")).alias("date_key"),
        "quantity",
        "unit_price",
        (F.col("quantity") * F.col("unit_price")).try_cast(LINE_AMOUNT).alias("total_amount"),
        "status",
    )


def build_star(
    customers: DataFrame, products: DataFrame, orders: DataFrame, *, dense_keys: bool = False
) -> Star:
    return Star(
        fact_orders=fact_orders(orders, products, dense_keys=dense_keys),
        dim_customers=dim_customers(customers),
        dim_products=dim_products(products),
        dim_date=dim_date(orders),
    )


def _rows_without(fact: DataFrame, key: str, dim: DataFrame) -> DataFrame:
    # Reduced per key first: one row for each key meets the dimension.
    per_key = fact.groupBy(key).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.min("order_id").alias("_first"),
        F.max("order_id").alias("_last"),
    )
    return per_key.join(dim.select(key), key, "left_anti").agg(
        F.lit(key).alias("key"),
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.min("_first").alias("first_order"),
        F.max("_last").alias("last_order"),
    )


def unresolved_rows(star: Star) -> DataFrame:
    """Fact rows per key column whose key is null or in no dimension row: how many, and the
    first and last of their order ids."""
    fact = star.fact_orders
    return (
        _rows_without(fact, "customer_key", star.dim_customers)
        .unionByName(_rows_without(fact, "product_key", star.dim_products))
        .unionByName(_rows_without(fact, "date_key", star.dim_date))
    )


def unresolved_keys(star: Star) -> DataFrame:
    """Fact rows per key column whose key is null or in no dimension row."""
    return unresolved_rows(star).select("key", "rows")


def check_star(star: Star, rows: int | None = None) -> None:
    """Raises unless the fact has rows and each of their keys is in its dimension.

    ``rows`` is the number of fact rows where that is known already.
    """
    if star.fact_orders.isEmpty() if rows is None else not rows:
        raise IntegrityError("there are no orders")
    # Three rows, one per key.
    problems = [r for r in unresolved_rows(star).collect() if r["rows"]]
    if problems:
        lines = [
            f"{r['key']}: {r['rows']} (orders {r['first_order']} to {r['last_order']})"
            for r in problems
        ]
        raise IntegrityError(f"fact rows whose key is in no dimension row: {'; '.join(lines)}")
