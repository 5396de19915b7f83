"""Metrics over the star; revenue is the fact's stored total_amount of completed orders."""

from __future__ import annotations

from dataclasses import replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.calendar import month_start, month_text
from tillwork.functions.money import mean_2, money_sum, percent_2
from tillwork.model import COMPLETED, MONEY_SUM, Star


def _completed(star: Star) -> DataFrame:
    return star.fact_orders.filter(F.col("status") == COMPLETED)


def _days(star: Star, columns: list[str]) -> tuple[DataFrame, list[str]]:
    """The days to join the fact with, and the columns to join on.

    A stored fact lies in a folder for each month. Joined on the month as well, it is read
    from the months of the days alone: Spark prunes the folders by the days that are left
    after any condition on them.
    """
    keys = ["date_key"]
    days = star.dim_date.select("date_key", *columns)
    if "month_key" in star.fact_orders.columns:
        keys.append("month_key")
        days = days.withColumn("month_key", F.expr("date_key div 100").cast("int"))
    # A date dimension has one row per calendar day, fewer than four million over
    # the whole range of the date type, so it can always be broadcast.
    return F.broadcast(days), keys


def _dated(star: Star) -> DataFrame:
    days, keys = _days(star, ["full_date"])
    return _completed(star).join(days, keys)


def of_days(star: Star, condition: Column) -> Star:
    """The star of some days: those whose calendar columns fulfil ``condition``.

    Every metric of it is of these days alone, and reads no other months of a stored fact.
    """
    dates = replace(star, dim_date=star.dim_date.filter(condition))
    days, keys = _days(dates, [])
    return replace(dates, fact_orders=star.fact_orders.join(days, keys, "left_semi"))


def monthly_revenue(star: Star) -> DataFrame:
    """Revenue, orders and average order value per month that has sales."""
    return (
        _dated(star)
        .groupBy(month_start(F.col("full_date")).alias("_month"))
        .agg(
            money_sum(F.col("total_amount")).alias("total_revenue"),
            F.count(F.lit(1)).alias("order_count"),
        )
        .orderBy("_month")
        .select(
            month_text(F.col("_month")).alias("month"),
            "total_revenue",
            "order_count",
            mean_2(F.col("total_revenue"), F.col("order_count")).alias("avg_order_value"),
        )
    )


def category_performance(star: Star) -> DataFrame:
    """Revenue, units and the mean price per order of each category."""
    per_product = (
        _completed(star)
        .groupBy("product_key")
        .agg(
            money_sum(F.col("total_amount")).alias("_revenue"),
            F.sum("quantity").alias("_units"),
            money_sum(F.col("unit_price")).alias("_prices"),
            F.count("unit_price").alias("_orders"),
        )
    )
    return (
        per_product.join(star.dim_products.select("product_key", "category"), "product_key")
        .groupBy("category")
        .agg(
            money_sum(F.col("_revenue")).alias("total_revenue"),
            F.sum("_units").alias("units_sold"),
            mean_2(money_sum(F.col("_prices")), F.sum("_orders")).alias("avg_price"),
        )
        .orderBy(F.desc("total_revenue"), "category")
    )


def _customer_totals(star: Star, as_of: Column) -> DataFrame:
    per_customer = (
        _dated(star)
        .groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money_sum(F.col("total_amount")).alias("total_spend"),
            F.min("full_date").alias("first_order_date"),
            F.max("full_date").alias("last_order_date"),
        )
    )
    people = star.dim_customers.select("customer_key", "customer_id", "full_name", "city")
    return per_customer.join(people, "customer_key").select(
        "customer_id",
        "full_name",
        "city",
        "order_count",
        "total_spend",
        "first_order_date",
        "last_order_date",
        F.datediff(as_of, "last_order_date").alias("days_since_last_order"),
    )


def customer_summary(
    star: Star, as_of: date | None = None, *, ordered: bool = True
) -> DataFrame:
    """The history of each customer with a completed order; ``as_of`` is today by default."""
    today = F.lit(as_of) if as_of else F.current_date()
    totals = _customer_totals(star, today)
    return totals.orderBy(F.desc("total_spend"), "customer_id") if ordered else totals


def repeat_customers(star: Star, *, ordered: bool = True) -> DataFrame:
    """Customers with two or more completed orders, and the repeat rate on each row."""
    totals = customer_summary(star, ordered=False)
    # Counted by their spend, which every buyer has: so the rate reads the same columns of
    # the fact as the customers do, and both share one scan and one shuffle.
    buyers = F.count("total_spend")
    rate = totals.agg(percent_2(F.count_if(F.col("order_count") >= 2), buyers)).scalar()
    repeaters = totals.filter(F.col("order_count") >= 2).select(
        "customer_id",
        "full_name",
        "city",
        "order_count",
        "total_spend",
        rate.alias("repeat_purchase_rate_pct"),
    )
    return repeaters.orderBy(F.desc("total_spend"), "customer_id") if ordered else repeaters


def daily_sales(star: Star) -> DataFrame:
    """Revenue, orders and distinct customers per day that has sales."""
    return (
        _dated(star)
        .groupBy(F.col("full_date").alias("sale_date"))
        .agg(
            money_sum(F.col("total_amount")).alias("total_revenue"),
            F.count(F.lit(1)).alias("order_count"),
            F.count_distinct("customer_key").alias("unique_customers"),
        )
        .orderBy("sale_date")
    )


def daily_customer_sales(star: Star) -> DataFrame:
    """Revenue and orders of each customer and day, which add up to ``daily_sales``.

    Rows of several loads can be put together: ``days_of`` adds up what it is given, and a
    customer who comes up in two of them still counts once.
    """
    return (
        _dated(star)
        .groupBy(F.col("full_date").alias("sale_date"), "customer_key")
        .agg(
            money_sum(F.col("total_amount")).alias("revenue"), F.count(F.lit(1)).alias("orders")
        )
    )


def merged_sales(sales: DataFrame) -> DataFrame:
    """``daily_customer_sales`` of several loads with one row for each customer and day."""
    return sales.groupBy("sale_date", "customer_key").agg(
        money_sum(F.col("revenue")).alias("revenue"), F.sum("orders").alias("orders")
    )


def days_of(sales: DataFrame) -> DataFrame:
    """``daily_sales`` of the days in ``daily_customer_sales`` of any number of loads."""
    return merged_sales(sales).groupBy("sale_date").agg(
        money_sum(F.col("revenue")).alias("total_revenue"),
        F.sum("orders").alias("order_count"),
        F.count("customer_key").alias("unique_customers"),
    )


def kpi_summary(star: Star) -> DataFrame:
    """One row: revenue, buying customers, orders, best category and repeat rate.

    Revenue and orders are those of the months, customers those of the customer view.
    """
    best = category_performance(star).limit(1).select("category").scalar()
    months = monthly_revenue(star)
    revenue = months.agg(money_sum(F.col("total_revenue"))).scalar()
    orders = months.agg(F.sum("order_count")).scalar()
    repeaters = F.count_if(F.col("order_count") >= 2)
    no_rate = F.lit(0).cast("decimal(18,2)")
    return customer_summary(star, ordered=False).agg(
        F.coalesce(revenue, F.lit(0).cast(MONEY_SUM)).alias("total_revenue"),
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(orders, F.lit(0)).alias("total_orders"),
        best.alias("best_category"),
        F.coalesce(percent_2(repeaters, F.count(F.lit(1))), no_rate).alias(
            "repeat_customer_rate_pct"
        ),
    )


def chart_series(star: Star) -> dict[str, DataFrame]:
    """The data behind the monthly line, the category bars and the top-ten bars."""
    top = customer_summary(star).limit(10)
    return {
        "monthly_revenue": monthly_revenue(star).select("month", "total_revenue"),
        "category_revenue": category_performance(star).select("category", "total_revenue"),
        "top_customers": top.orderBy("total_spend", F.desc("customer_id")).select(
            "full_name", "total_spend"
        ),
    }


def create_views(star: Star, as_of: date | None = None) -> None:
    """The metrics as session views, for queries in SQL.

    ``mvw_daily_sales`` is created by ``publish.create_daily_sales_view``, as it
    reads the stored rows.
    """
    views = {
        "vw_monthly_revenue": monthly_revenue(star),
        "vw_category_performance": category_performance(star),
        "vw_customer_summary": customer_summary(star, as_of),
        "vw_repeat_customers": repeat_customers(star),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
