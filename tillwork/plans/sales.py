"""The sales questions over the operational tables.

Rows come back in the order of a report; every order ends in a unique key, so it
does not depend on chance. The functions that return one row per customer, order
or payment take ``ordered=False``, which saves the sort when the result is
written to a table.

Two revenue definitions are in use here: quantity times the current product price
("revenue", "order value") and the amounts paid ("payments", "spending").

Sums are taken per join key before the join wherever the question allows it. Each
key then meets its partner as one row, however many rows it had.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.calendar import month_start, month_title
from tillwork.functions.money import money_sum, percent_2
from tillwork.model import COMPLETED, MONEY_SUM, RETURNED
from tillwork.operators.hot import MIN_HOT_ROWS, split_hot
from tillwork.operators.ordered import (
    next_value,
    previous_value,
    rank_by_amount,
    row_numbers,
    running_sum,
    spread_blocks,
)


def _sorted(df: DataFrame, ordered: bool, *keys: str | Column) -> DataFrame:
    return df.orderBy(*keys) if ordered else df


def _times(quantity: str, price: str) -> Column:
    return (F.col(quantity).cast("decimal(18,0)") * F.col(price)).cast(MONEY_SUM)


def revenue_by_category(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Completed orders and their value per category."""
    per_product = (
        orders.filter(F.col("status") == COMPLETED)
        .groupBy("product_id")
        .agg(F.count("order_id").alias("_orders"), F.sum("quantity").alias("_units"))
    )
    return (
        per_product.join(products, "product_id")
        .groupBy("category")
        .agg(
            F.sum("_orders").alias("total_orders"),
            money_sum(_times("_units", "price")).alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def _paid_per_order(payments: DataFrame) -> DataFrame:
    return payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_payments"), money_sum(F.col("amount")).alias("_paid")
    )


def _paid_per_customer(orders: DataFrame, payments: DataFrame) -> DataFrame:
    return (
        orders.select("order_id", "customer_id")
        .join(_paid_per_order(payments), "order_id")
        .groupBy("customer_id")
        .agg(
            F.sum("_payments").alias("orders_placed"),
            money_sum(F.col("_paid")).alias("total_spent"),
        )
    )


def top_customers_by_payments(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, n: int = 5
) -> DataFrame:
    """The customers who paid most for completed orders."""
    completed = orders.filter(F.col("status") == COMPLETED)
    return (
        _paid_per_customer(completed, payments)
        .join(customers.select("customer_id", "full_name", "city"), "customer_id")
        .orderBy(F.desc("total_spent"), "customer_id")
        .limit(n)
        .select("full_name", "city", "orders_placed", "total_spent")
    )


def monthly_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments per month, for orders of any status."""
    return (
        payments.join(orders.select("order_id"), "order_id")
        .groupBy(month_start(F.col("payment_date")).alias("_month"))
        .agg(
            F.count("payment_id").alias("payments_received"),
            money_sum(F.col("amount")).alias("monthly_revenue"),
        )
        .orderBy("_month")
        .select(month_title(F.col("_month")).alias("month"), "payments_received", "monthly_revenue")
    )


def popular_products(products: DataFrame, orders: DataFrame, n: int = 10) -> DataFrame:
    """The products with most units sold; returned orders do not count, others do."""
    per_product = (
        orders.filter(F.col("status") != RETURNED)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), F.count("order_id").alias("times_ordered"))
    )
    return (
        per_product.join(products, "product_id")
        .orderBy(F.desc("units_sold"), "product_id")
        .limit(n)
        .select("title", "category", "price", "units_sold", "times_ordered")
    )


def customer_rank_in_city(
    customers: DataFrame, orders: DataFrame, payments: DataFrame, *, ordered: bool = True
) -> DataFrame:
    """Each paying customer's rank by spending among the customers of the same city."""
    spending = (
        _paid_per_customer(orders, payments)
        .join(customers.select("customer_id", "full_name", "city"), "customer_id")
        .select("customer_id", "city", "full_name", "total_spent")
    )
    ranked = rank_by_amount(
        spending, "rank_in_city", partition_by=["city"], amount="total_spent"
    )
    return _sorted(ranked, ordered, "city", "rank_in_city", "customer_id").select(
        "city", "full_name", "total_spent", "rank_in_city"
    )


def _payment_levels(payments: DataFrame) -> list[Column]:
    # A day may hold any share of the payments, so it is cut into blocks of ids.
    return [F.col("payment_date"), spread_blocks(payments, "payment_id")]


def running_revenue(payments: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Total paid up to and including each payment, by date and id."""
    running = running_sum(
        payments.select("payment_id", "payment_date", "amount"),
        "running_total",
        F.col("amount"),
        MONEY_SUM,
        order_by=["payment_id"],
        levels=_payment_levels(payments),
    )
    return _sorted(running, ordered, "payment_date", "payment_id").select(
        "payment_date", "amount", "running_total"
    )


def payment_vs_previous(payments: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Each payment beside the one before it."""
    paired = previous_value(
        payments.select("payment_id", "payment_date", "amount"),
        "previous_payment",
        "amount",
        key="payment_id",
        levels=_payment_levels(payments),
    ).withColumn("difference", F.col("amount") - F.col("previous_payment"))
    return _sorted(paired, ordered, "payment_date", "payment_id")


def payment_vs_next(payments: DataFrame, *, ordered: bool = True) -> DataFrame:
    """Each payment beside the one after it."""
    paired = next_value(
        payments.select("payment_id", "payment_date", "amount"),
        "next_payment",
        "amount",
        key="payment_id",
        levels=_payment_levels(payments),
    ).withColumn("upcoming_change", F.col("next_payment") - F.col("amount"))
    return _sorted(paired, ordered, "payment_date", "payment_id")


def order_sequence(
    orders: DataFrame,
    customers: DataFrame,
    *,
    ordered: bool = True,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Number of each order in its customer's history, by date, then order id."""
    slim = orders.select("order_id", "customer_id", "order_date", "status")
    names = customers.select("customer_id", "full_name")
    usual, busy, hot = split_hot(slim, ["customer_id"], min_hot_rows)
    # The window and the join share one shuffle on the customer.
    by_date = Window.partitionBy("customer_id").orderBy("order_date", "order_id")
    usual = usual.withColumn("order_number", F.row_number().over(by_date).cast("bigint")).join(
        names, "customer_id"
    )
    busy = row_numbers(
        busy,
        "order_number",
        order_by=["order_id"],
        levels=[F.col("order_date"), spread_blocks(orders, "order_id")],
        partition_by=["customer_id"],
    ).join(names.join(hot, "customer_id", "left_semi"), "customer_id")
    numbered = usual.unionByName(busy)
    return _sorted(numbered, ordered, "full_name", "order_number", "order_id").select(
        "full_name", "order_id", "order_date", "status", "order_number"
    )


def order_sizes(
    orders: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    payments: DataFrame,
    *,
    bands: tuple[float, float] = (1_000, 5_000),
    ordered: bool = True,
) -> DataFrame:
    """Paid orders labelled by the amount paid: below the first band, the second, or above."""
    small, medium = bands
    size = (
        F.when(F.col("amount") < small, "Small")
        .when(F.col("amount") < medium, "Medium")
        .otherwise("Large")
    )
    labelled = (
        orders.select("order_id", "customer_id", "product_id")
        .join(products.select("product_id", F.col("title").alias("product")), "product_id")
        .join(customers.select("customer_id", "full_name"), "customer_id")
        .join(payments.select("payment_id", "order_id", "amount"), "order_id")
        .withColumn("order_size", size)
    )
    return _sorted(
        labelled, ordered, F.desc("amount"), "order_id", "payment_id", "product_id"
    ).select("order_id", "full_name", "product", "amount", "order_size")


def never_completed(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers without a completed order, with or without other orders."""
    # Distinct ids keep a customer with very many orders from skewing the join.
    buyers = orders.filter(F.col("status") == COMPLETED).select("customer_id").distinct()
    return (
        customers.join(buyers, "customer_id", "left_anti")
        .orderBy("full_name", "customer_id")
        .select("full_name", "email", "city")
    )


def preferred_payment_method(
    customers: DataFrame, orders: DataFrame, payments: DataFrame
) -> DataFrame:
    """The most used payment method of each city; methods that tie all appear."""
    per_customer = (
        payments.select("order_id", "method")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .groupBy("customer_id", "method")
        .agg(F.count(F.lit(1)).alias("_uses"))
    )
    per_city = (
        per_customer.join(customers.select("customer_id", "city"), "customer_id")
        .groupBy("city", "method")
        .agg(F.sum("_uses").alias("usage_count"))
    )
    by_use = Window.partitionBy("city").orderBy(F.desc("usage_count"))
    return (
        per_city.withColumn("_rank", F.rank().over(by_use))
        .filter(F.col("_rank") == 1)
        .orderBy("city", "method")
        .select("city", F.col("method").alias("preferred_payment_method"), "usage_count")
    )


def return_rates(products: DataFrame, orders: DataFrame, *, risk_pct: int = 20) -> DataFrame:
    """Share of orders returned per ordered product; above ``risk_pct`` it is a risk."""
    per_product = orders.groupBy("product_id").agg(
        F.count("order_id").alias("total_orders"),
        F.count_if(F.col("status") == RETURNED).alias("returns"),
    )
    # Compared as whole numbers: a rate of exactly risk_pct is still normal.
    risky = F.col("returns") * 100 > F.col("total_orders") * risk_pct
    return (
        per_product.join(products.select("product_id", "title"), "product_id")
        .withColumn("return_rate_pct", percent_2(F.col("returns"), F.col("total_orders")))
        .withColumn("return_flag", F.when(risky, "High Return Risk").otherwise("Normal"))
        .orderBy(F.desc("return_rate_pct"), "product_id")
        .select("title", "total_orders", "returns", "return_rate_pct", "return_flag")
    )
