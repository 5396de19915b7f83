"""The four sections of the sales report; revenue is quantity times product price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.functions.calendar import month_start, month_text
from tillwork.functions.money import money_sum, percent_2
from tillwork.model import COMPLETED, MONEY_SUM
from tillwork.plans.sales import revenue_by_category


def category_revenue(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Value of completed orders per category."""
    return revenue_by_category(orders, products).select("category", "total_revenue")


def top_customers(
    customers: DataFrame, orders: DataFrame, products: DataFrame, n: int = 5
) -> DataFrame:
    """The customers with the largest value of completed orders."""
    spend = (
        orders.filter(F.col("status") == COMPLETED)
        .select("customer_id", "product_id", "quantity")
        .join(products.select("product_id", "price"), "product_id")
        .groupBy("customer_id")
        .agg(money_sum(F.col("quantity") * F.col("price")).alias("total_spend"))
    )
    return (
        spend.join(customers.select("customer_id", "full_name", "city"), "customer_id")
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(n)
        .select("customer_id", "full_name", "city", "total_spend")
    )


def orders_by_status(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status")
        .agg(F.count(F.lit(1)).alias("orders_count"))
        .orderBy(F.desc("orders_count"), "status")
    )


def month_over_month(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue per month beside the month before it that has any."""
    units = (
        orders.filter(F.col("status") == COMPLETED)
        .groupBy("product_id", month_start(F.col("order_date")).alias("_month"))
        .agg(F.sum("quantity").cast("decimal(18,0)").alias("_units"))
    )
    monthly = (
        units.join(products.select("product_id", "price"), "product_id")
        .groupBy("_month")
        .agg(money_sum((F.col("_units") * F.col("price")).cast(MONEY_SUM)).alias("revenue"))
    )
    # One row per month is left, so a window without partitions is small.
    by_month = Window.orderBy("_month")
    change = (F.col("revenue") - F.col("prev_month_revenue")).cast(MONEY_SUM)
    return (
        monthly.withColumn("prev_month_revenue", F.lag("revenue").over(by_month))
        .withColumn("mom_change", change)
        .withColumn("mom_change_pct", percent_2(F.col("mom_change"), F.col("prev_month_revenue")))
        .orderBy("_month")
        .select(
            month_text(F.col("_month")).alias("month"),
            "revenue",
            "prev_month_revenue",
            "mom_change",
            "mom_change_pct",
        )
    )


def sales_report(
    customers: DataFrame, products: DataFrame, orders: DataFrame
) -> dict[str, DataFrame]:
    """All sections by name."""
    return {
        "revenue_by_category": category_revenue(orders, products),
        "top_customers": top_customers(customers, orders, products),
        "orders_by_status": orders_by_status(orders),
        "mom_revenue": month_over_month(orders, products),
    }
