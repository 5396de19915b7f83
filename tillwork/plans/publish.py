"""Stored tables: staged loads that become visible all at once, and their refresh.

A load writes every table below a folder of its own. Only when its checks have
passed do readers get that folder (``versions``). A load that fails, or loses executors
halfway, leaves no trace for readers, and readers are never locked out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwork.model import COMPLETED, MONEY_SUM, Star
from tillwork.plans import cleaning, metrics
from tillwork.plans.constraints import (
    ConstraintError,
    Rule,
    any_broken,
    broken_rules,
    enforce,
    measures,
    operational_key_violations,
    operational_rules,
    star_key_violations,
    star_rules,
    unique_violations,
)
from tillwork.plans.star import build_star, check_star, dim_date_of
from tillwork.plans.versions import (
    ANY,
    current_folder,
    current_version,
    note_uses,
    remove,
    switch,
)
from tillwork.session import shared_folder, staged

Tables = dict[str, DataFrame]

# Parts of a month's stored customer sales that late rows may add before they are put together.
MOST_PARTS = 16


def read_table(
    spark: SparkSession, root: str, name: str, columns: list[str] | None = None
) -> DataFrame:
    """A table of the last published load."""
    df = spark.read.parquet(f"{current_folder(spark, root)}/{name}")
    return df.select(*columns) if columns else df


def read_tables(spark: SparkSession, root: str, names: list[str]) -> Tables:
    """Several tables of one load, the last published, even if another follows meanwhile."""
    return read_tables_at(spark, current_folder(spark, root), names)


def read_tables_at(spark: SparkSession, folder: str, names: list[str]) -> Tables:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def read_star(spark: SparkSession, root: str) -> Star:
    return _star_at(spark, current_folder(spark, root))


def _star_at(spark: SparkSession, folder: str) -> Star:
    return Star(
        fact_orders=spark.read.parquet(f"{folder}/fact_orders"),
        dim_customers=spark.read.parquet(f"{folder}/dim_customers"),
        dim_products=spark.read.parquet(f"{folder}/dim_products"),
        dim_date=spark.read.parquet(f"{folder}/dim_date"),
    )


def publish(
    spark: SparkSession,
    root: str,
    tables: dict[str, DataFrame | Callable[[Tables], DataFrame]],
    *,
    rules: dict[str, list[Rule]] | None = None,
    check: Callable[[Tables, dict[str, int]], None] | None = None,
    partition_by: dict[str, str] | None = None,
    based_on: object = ANY,
    version: str | None = None,
    uses: set[str] | None = None,
) -> str:
    """Writes the tables as a new version, checks what was written, and switches to it.

    A table may be a function of those before it, as they are stored. Rows are counted, and
    the ``rules`` about single rows checked, while a table is written; rows that break one are
    named from what was stored. ``load_summary`` has the counts. ``check`` is for what takes more than one row: it sees the stored tables and their
    numbers of rows, so the work behind the tables is done once. With ``based_on``, a version
    that the tables were made from, the switch fails if another one is current by then.
    ``uses`` names older versions whose files the new one goes on reading.
    """
    version = version or uuid.uuid4().hex
    stored, rows, broken, summary = {}, {}, [], []
    for name, df in tables.items():
        if callable(df):
            df = df(stored)
        path = f"{root}/v={version}/{name}"
        column = (partition_by or {}).get(name)
        own = (rules or {}).get(name, [])
        seen = Observation()
        noted = {
            "rows": F.count(F.lit(1)),
            "broken": any_broken(own),
            "revenue": _completed_revenue(df),
        }
        # Rebalancing keeps files per partition few and splits a hot partition.
        dealt = df.hint("rebalance", column) if column else df
        writer = dealt.observe(seen, *[m.alias(n) for n, m in noted.items()]).write
        (writer.partitionBy(column) if column else writer).parquet(path)
        # An empty partitioned table has no file that could tell its schema.
        stored[name] = spark.read.schema(df.schema).parquet(path)
        found = seen.get
        rows[name] = found["rows"]
        summary.append((name, found["rows"], found["revenue"]))
        if found["broken"]:
            # Only a load that will be refused is read again, for the rules and their rows.
            counts = stored[name].agg(*[m.alias(n) for n, m in measures(df, own).items()])
            broken += broken_rules(name, own, counts.first())
    if broken:
        raise ConstraintError("; ".join(broken))
    if check:
        check(stored, rows)
    counts = spark.createDataFrame(summary, _SUMMARY).coalesce(1)
    counts.write.parquet(f"{root}/v={version}/{SUMMARY}")
    note_uses(spark, root, version, uses or set())
    switch(spark, root, version, based_on)
    return version


# The counts of a version's tables, taken while they were written.
SUMMARY = "_summary"
_SUMMARY = f"tbl string, row_count long, completed_revenue {MONEY_SUM}"


def _completed_revenue(df: DataFrame) -> Column:
    """The revenue of completed orders; null for tables that have none."""
    if not {"status", "total_amount"} <= set(df.columns):
        return F.lit(None).cast(MONEY_SUM)
    completed = F.when(F.col("status") == COMPLETED, F.col("total_amount"))
    return F.coalesce(F.sum(completed).cast(MONEY_SUM), F.lit(0).cast(MONEY_SUM))


def load_summary(spark: SparkSession, root: str) -> DataFrame:
    """``verify`` of the current version's tables, as counted while they were written."""
    return spark.read.schema(_SUMMARY).parquet(f"{current_folder(spark, root)}/{SUMMARY}")


def load_operational(
    spark: SparkSession,
    root: str,
    customers_raw: DataFrame,
    products_raw: DataFrame,
    orders_raw: DataFrame,
    payments_raw: DataFrame | None = None,
) -> str:
    """Cleans the feeds and publishes the accepted tables and the dead letter.

    Without ``payments_raw`` the new version has no payments: those of an older one may
    point at orders that are gone. A re-run replaces the tables, so it never adds rows
    twice.
    """
    work = shared_folder(spark)

    customers = staged(cleaning.annotate_customers(customers_raw), f"{work}/customers")
    products = staged(cleaning.annotate_products(products_raw), f"{work}/products")
    good_customers, good_products = cleaning.accepted(customers), cleaning.accepted(products)
    orders = staged(
        cleaning.annotate_orders(orders_raw, good_customers, good_products), f"{work}/orders"
    )
    feeds = {"customers": customers, "products": products, "orders": orders}
    if payments_raw is not None:
        good_orders = cleaning.accepted(orders)
        feeds["payments"] = staged(
            cleaning.annotate_payments(payments_raw, good_orders), f"{work}/payments"
        )
    tables = {name: cleaning.accepted(df) for name, df in feeds.items()}
    tables["dead_letter"] = cleaning.dead_letter(
        *[cleaning.rejected(df, name) for name, df in feeds.items()]
    )

    def check(t: Tables, rows: dict[str, int]) -> None:
        keyed = t["customers"], t["products"], t["orders"], t.get("payments")
        enforce(operational_key_violations(*keyed))

    try:
        return publish(spark, root, tables, rules=operational_rules(), check=check)
    finally:
        remove(spark, work)


def _with_month(fact: DataFrame) -> DataFrame:
    return fact.withColumn("month_key", F.expr("date_key div 100").cast("int"))


def load_star(
    spark: SparkSession,
    root: str,
    customers: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    *,
    dense_keys: bool = False,
) -> str:
    """Builds, checks and publishes the star; ``refresh_daily_sales`` follows it.

    The fact is stored by month (``month_key``), which date ranges and the
    incremental refresh prune by.
    """
    star = build_star(customers, products, orders, dense_keys=dense_keys)
    # The days come from the stored fact: from ``orders`` they would cost the work behind them
    # a second time.
    tables = {
        "dim_customers": star.dim_customers,
        "dim_products": star.dim_products,
        "fact_orders": _with_month(star.fact_orders),
        "dim_date": lambda t: dim_date_of(t["fact_orders"]),
    }

    keys = [["order_id"], ["order_key"]] if dense_keys else [["order_id"]]

    def check(t: Tables, rows: dict[str, int]) -> None:
        stored = Star(
            fact_orders=t["fact_orders"],
            dim_customers=t["dim_customers"],
            dim_products=t["dim_products"],
            dim_date=t["dim_date"],
        )
        check_star(stored, rows["fact_orders"])
        enforce(star_key_violations(stored, keys))

    return publish(
        spark,
        root,
        tables,
        rules=star_rules(star),
        check=check,
        partition_by={"fact_orders": "month_key"},
    )


def verify(tables: Tables) -> DataFrame:
    """Rows per stored table and, beside the fact, its completed revenue."""
    parts = [
        df.agg(
            F.lit(name).alias("tbl"),
            F.count(F.lit(1)).alias("row_count"),
            _completed_revenue(df).alias("completed_revenue"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def row_counts(tables: Tables) -> DataFrame:
    """Rows per table."""
    parts = [
        df.agg(F.lit(name).alias("tbl"), F.count(F.lit(1)).alias("row_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


# The months of a version's daily sales and the versions whose files hold their customers.
Parts = list[tuple[int, str]]


def _month_of(day: str) -> Column:
    return (F.year(day) * 100 + F.month(day)).alias("month_key")


def _months(sales: DataFrame) -> list[int]:
    """The months of some customer sales, at most one for each of the calendar's."""
    return sorted(r["month_key"] for r in sales.select(_month_of("sale_date")).distinct().collect())


def _customer_sales(spark: SparkSession, root: str, like: DataFrame, parts: Parts) -> DataFrame:
    """The stored customer sales in ``parts``; ``like`` has the columns."""
    paths = [f"{root}/v={version}/daily_customers/month_key={month}" for month, version in parts]
    columns = [c for c in like.columns if c != "month_key"]
    empty = like.select(*columns).limit(0)
    return spark.read.schema(empty.schema).parquet(*paths) if paths else empty


def _publish_daily(
    spark: SparkSession,
    root: str,
    sales: DataFrame,
    daily: Callable[[DataFrame], DataFrame],
    parts: Parts,
    based_on: object = ANY,
) -> str:
    """Stores ``sales``, then ``daily`` made from them; ``parts`` are those of older versions."""
    version = uuid.uuid4().hex

    def all_parts(t: Tables) -> DataFrame:
        new = [(month, version) for month in _months(t["daily_customers"])]
        return spark.createDataFrame(parts + new, "month_key int, version string").coalesce(1)

    def one_row_per_day(t: Tables, rows: dict[str, int]) -> None:
        enforce(unique_violations(t["daily_sales"], "daily_sales", [["sale_date"]]))

    return publish(
        spark,
        root,
        {
            "daily_customers": sales.withColumn("month_key", _month_of("sale_date")),
            "daily_parts": all_parts,
            "daily_sales": lambda t: daily(t["daily_customers"].drop("month_key")),
        },
        check=one_row_per_day,
        partition_by={"daily_customers": "month_key"},
        based_on=based_on,
        version=version,
        uses={v for _, v in parts},
    )


def _stored_daily(spark: SparkSession, root: str) -> tuple[str, DataFrame, Parts]:
    version = current_version(spark, root)
    tables = read_tables_at(spark, f"{root}/v={version}", ["daily_sales", "daily_parts"])
    # One row for each month and part, of which there are at most MOST_PARTS a month.
    parts = [(r["month_key"], r["version"]) for r in tables["daily_parts"].collect()]
    return version, tables["daily_sales"], parts


def refresh_daily_sales(
    spark: SparkSession, root: str, star: Star, months: list[date] | None = None
) -> str:
    """Computes the stored daily sales below ``root`` again; readers keep the old rows until then.

    With ``months`` (any day of each) only the days of those months are computed again, from
    the whole fact rows of the month, as when orders were changed or taken back. The other
    days are copied, and their customers stay where they are stored; there is one row a day.
    For orders that only came late, ``add_daily_sales`` does with less. If another refresh ends
    meanwhile, this one raises ``ConcurrentUpdate`` and changes nothing.
    """
    if months is None:
        sales = metrics.daily_customer_sales(star)
        return _publish_daily(spark, root, sales, lambda s: metrics.days_of(s).orderBy("sale_date"), [])
    keys = sorted({m.year * 100 + m.month for m in months})
    fact = star.fact_orders if "month_key" in star.fact_orders.columns else _with_month(
        star.fact_orders
    )
    touched = Star(
        fact_orders=fact.filter(F.col("month_key").isin(keys)),
        dim_customers=star.dim_customers,
        dim_products=star.dim_products,
        dim_date=star.dim_date,
    )
    version, stored, parts = _stored_daily(spark, root)
    kept = stored.filter(~_month_of("sale_date").isin(keys))
    return _publish_daily(
        spark,
        root,
        metrics.daily_customer_sales(touched),
        lambda s: kept.unionByName(metrics.days_of(s)),
        [p for p in parts if p[0] not in keys],
        based_on=version,
    )


def add_daily_sales(spark: SparkSession, root: str, late: Star) -> str:
    """Adds orders that came late to the stored daily sales below ``root``.

    ``late.fact_orders`` has the new rows alone; rows that were added before count twice.
    Distinct customers of two loads cannot be added up, so each day's customers are stored
    beside its row. Only the late rows and the stored customers of the days they touch are
    read, and only new customer rows are written: a month has several parts then. With
    ``MOST_PARTS`` of them they are put together. If another refresh ends meanwhile, this one
    raises ``ConcurrentUpdate`` and changes nothing.
    """
    version, stored, parts = _stored_daily(spark, root)
    sales = metrics.daily_customer_sales(late)
    months = _months(sales)
    held = {m: [p for p in parts if p[0] == m] for m in months}
    crowded = {m for m, of in held.items() if len(of) >= MOST_PARTS}
    older = [p for m in months if m not in crowded for p in held[m]]
    if crowded:
        whole = _customer_sales(spark, root, sales, [p for m in crowded for p in held[m]])
        sales = metrics.merged_sales(sales.unionByName(whole))

    def daily(fresh: DataFrame) -> DataFrame:
        days = fresh.select("sale_date").distinct()
        before = _customer_sales(spark, root, fresh, older).join(days, "sale_date", "left_semi")
        untouched = stored.join(days, "sale_date", "left_anti")
        return untouched.unionByName(metrics.days_of(fresh.unionByName(before)))

    rest = [p for p in parts if p[0] not in crowded]
    return _publish_daily(spark, root, sales, daily, rest, based_on=version)


def read_daily_sales(spark: SparkSession, root: str) -> DataFrame:
    """The stored rows; never recomputed on reading."""
    return read_table(spark, root, "daily_sales")


def create_daily_sales_view(spark: SparkSession, root: str) -> None:
    """The stored rows as a session view; create it again after a refresh."""
    read_daily_sales(spark, root).createOrReplaceTempView("mvw_daily_sales")
