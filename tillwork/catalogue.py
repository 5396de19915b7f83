"""Every query by name, over the retail tables derived from one data folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwork.functions.calendar import date_key
from tillwork.functions.casts import price, strict_date, whole_number
from tillwork.functions.text import NULL_WORDS, cell
from tillwork.model import NUMBER_LIMITS, RAW_CUSTOMERS, STATUSES, Star
from tillwork.operators.ordered import row_numbers, spread_blocks
from tillwork.plans import (
    cleaning,
    constraints,
    generate,
    metrics,
    publish,
    reports,
    sales,
    sinks,
    star,
    versions,
    views,
)
from tillwork.session import shared_folder, staged
from tillwork.sources import feeds
from tillwork.sources import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# The test tables hold larger amounts and more returns than the shop the default
# limits were made for.
SIZE_BANDS = (100_000, 300_000)
RISK_PCT = 35
AS_OF = date(2002, 1, 1)
# Orders from this day on reach the warehouse with a later load. It lies inside a
# month, so that month is stored in part before the refresh.
LATE_FROM = date(1997, 6, 15)


def fixture_star(spark: SparkSession, d: str, *, numbered: bool = False) -> Star:
    """The star of the test tables. Metrics never look at the order id, so they do
    without ``numbered``, which gives each fact row one of its own."""
    orders = fx.single_product_orders(spark, d) if numbered else fx.orders(spark, d)
    return star.build_star(fx.customers(spark, d), fx.products(spark, d), orders)


def _annotated(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    customers = cleaning.annotate_customers(fx.customers_raw(spark, d))
    products = cleaning.annotate_products(fx.products_raw(spark, d))
    orders = cleaning.annotate_orders(
        fx.orders_raw(spark, d), cleaning.accepted(customers), cleaning.accepted(products)
    )
    return {"customers": customers, "products": products, "orders": orders}


def _customers_clean(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return cleaning.clean_customers(fx.customers_raw(spark, d))


def _products_clean(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return cleaning.clean_products(fx.products_raw(spark, d))


def _orders_clean(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    customers, products = _customers_clean(spark, d)[0], _products_clean(spark, d)[0]
    return cleaning.clean_orders(fx.orders_raw(spark, d), customers, products)


def _broken_parents(spark: SparkSession, d: str) -> DataFrame:
    """What becomes of orders whose customer or product id is no number."""
    customers, products = _customers_clean(spark, d)[0], _products_clean(spark, d)[0]
    feed = fx.broken_parents_raw(spark, d)
    return cleaning.clean_orders(feed, customers, products)[1]


def _payments_clean(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return cleaning.clean_payments(fx.payments_raw(spark, d), fx.order_headers(spark, d))


def _dead_letter(spark: SparkSession, d: str) -> DataFrame:
    feeds_ = _annotated(spark, d).items()
    return cleaning.dead_letter(*[cleaning.rejected(df, name) for name, df in feeds_])


def _key_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rejected rows of feeds with repeated or broken ids, long texts and tiny prices."""
    raw = fx.repeated_raw(spark, d)
    people = fx.customers(spark, d)
    parents = people, people.withColumnRenamed("customer_id", "product_id")
    rejects = {
        "customers": (cleaning.clean_customers(raw["customers"])[1], "customer_id", "full_name"),
        "products": (cleaning.clean_products(raw["products"])[1], "product_id", "title"),
        "orders": (cleaning.clean_orders(raw["orders"], *parents)[1], "order_id", "quantity"),
    }
    parts = [
        df.select("source_table", F.col(key).alias("id"), F.col(text).alias("cell"), "rejection_reason")
        for df, key, text in rejects.values()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _load_counts(spark: SparkSession, d: str) -> DataFrame:
    return cleaning.load_counts(_annotated(spark, d))


# The dirty feeds with types but before any rule: what constraint checks are for.


def _customers_typed(spark: SparkSession, d: str) -> DataFrame:
    def text(name: str):
        return F.nullif(cell(F.col(name)), F.lit("")).alias(name)

    return fx.customers_raw(spark, d).select(
        whole_number(F.col("customer_id")).alias("customer_id"),
        text("full_name"),
        F.lower(text("email")).alias("email"),
        text("city"),
        strict_date(F.col("signup_date")).alias("signup_date"),
    )


def _products_typed(spark: SparkSession, d: str) -> DataFrame:
    return fx.products_raw(spark, d).select(
        whole_number(F.col("product_id")).alias("product_id"),
        F.nullif("title", F.lit("")).alias("title"),
        F.nullif("category", F.lit("")).alias("category"),
        price(F.col("price")).alias("price"),
    )


def _orders_typed(spark: SparkSession, d: str) -> DataFrame:
    return fx.orders_raw(spark, d).select(
        whole_number(F.col("order_id")).alias("order_id"),
        whole_number(F.col("customer_id")).alias("customer_id"),
        whole_number(F.col("product_id")).alias("product_id"),
        whole_number(F.col("quantity"), "int").alias("quantity"),
        strict_date(F.col("order_date")).alias("order_date"),
        "status",
    )


def _nulls(spark: SparkSession, d: str) -> DataFrame:
    customers = ["customer_id", "full_name", "email", "city", "signup_date"]
    orders = ["order_id", "customer_id", "product_id", "quantity", "order_date", "status"]
    products = ["product_id", "title", "category", "price"]
    return (
        constraints.null_violations(_customers_typed(spark, d), "customers", customers)
        .unionByName(constraints.null_violations(_products_typed(spark, d), "products", products))
        .unionByName(constraints.null_violations(_orders_typed(spark, d), "orders", orders))
    )


def _unique(spark: SparkSession, d: str) -> DataFrame:
    lines = fx.order_lines(spark, d)
    return (
        constraints.unique_violations(
            _customers_typed(spark, d), "customers", [["customer_id"], ["email"]]
        )
        .unionByName(
            constraints.unique_violations(
                lines, "lines", [["order_id"], ["order_id", "product_id"]]
            )
        )
        .unionByName(
            constraints.unique_violations(fx.payments(spark, d), "payments", [["payment_id"]])
        )
    )


def _checks(spark: SparkSession, d: str) -> DataFrame:
    orders = {
        "quantity > 0": F.col("quantity") > 0,
        "status is known": F.col("status").isin(*STATUSES),
    }
    return constraints.check_violations(_orders_typed(spark, d), "orders", orders).unionByName(
        constraints.check_violations(
            fx.payments(spark, d), "payments", {"amount > 0": F.col("amount") > 0}
        )
    )


def _foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    orders = _orders_typed(spark, d)
    return (
        constraints.foreign_key_violations(
            orders, "orders", "customer_id", fx.customers(spark, d)
        )
        .unionByName(
            constraints.foreign_key_violations(
                orders, "orders", "product_id", fx.products(spark, d)
            )
        )
        .unionByName(
            constraints.foreign_key_violations(
                fx.payments(spark, d), "payments", "order_id", fx.order_headers(spark, d)
            )
        )
    )


def _widths(spark: SparkSession, d: str) -> DataFrame:
    # Narrower than the model's limits, which no fixture row exceeds.
    return (
        constraints.width_violations(_customers_typed(spark, d), "customers", {"email": 18})
        .unionByName(
            constraints.width_violations(
                fx.products(spark, d), "products", {"title": 9}, NUMBER_LIMITS["products"]
            )
        )
        .unionByName(
            constraints.width_violations(
                fx.payments(spark, d), "payments", {"method": 20}, {"amount": (7, 2)}
            )
        )
    )


def _operational(spark: SparkSession, d: str) -> DataFrame:
    return constraints.operational_violations(
        _customers_typed(spark, d),
        _products_typed(spark, d),
        _orders_typed(spark, d),
        fx.payments(spark, d),
    )


def _star_rules(spark: SparkSession, d: str) -> DataFrame:
    return constraints.star_violations(fixture_star(spark, d), [["order_id"]])


def _unresolved(spark: SparkSession, d: str) -> DataFrame:
    # The raw orders: some name customers and products that do not exist.
    return star.unresolved_keys(
        star.build_star(
            fx.customers(spark, d), fx.products(spark, d), _orders_typed(spark, d)
        )
    )


def _unresolved_rows(spark: SparkSession, d: str) -> DataFrame:
    return star.unresolved_rows(
        star.build_star(
            fx.customers(spark, d), fx.products(spark, d), _orders_typed(spark, d)
        )
    )


def _rule_samples(spark: SparkSession, d: str) -> DataFrame:
    rules = constraints.not_null(["customer_id", "product_id", "quantity", "order_date"])
    rules += constraints.checks(
        {"quantity > 0": F.col("quantity") > 0, "status is known": F.col("status").isin(*STATUSES)}
    )
    return constraints.rule_samples(_orders_typed(spark, d), "orders", rules, "order_id")


def _row_counts(spark: SparkSession, d: str) -> DataFrame:
    operational = {
        "products": fx.products(spark, d),
        "customers": fx.customers(spark, d),
        "orders": fx.single_product_orders(spark, d),
        "payments": fx.payments(spark, d),
    }
    return publish.row_counts(operational | fixture_star(spark, d).tables())


def _loaded(spark: SparkSession, d: str) -> str:
    root = shared_folder(spark)
    publish.load_star(
        spark,
        root,
        fx.customers(spark, d),
        fx.products(spark, d),
        fx.single_product_orders(spark, d),
    )
    return root


def _load_verification(spark: SparkSession, d: str) -> DataFrame:
    return publish.load_summary(spark, _loaded(spark, d))


def _stored_daily_sales(spark: SparkSession, d: str) -> DataFrame:
    root = _loaded(spark, d)
    daily = f"{root}/daily"
    publish.refresh_daily_sales(spark, daily, publish.read_star(spark, root))
    return publish.read_daily_sales(spark, daily)


def _incremental_daily_sales(spark: SparkSession, d: str) -> DataFrame:
    """Early orders, then those of the rest in two deliveries that touch the same days."""
    root = shared_folder(spark)
    warehouse, daily = f"{root}/warehouse", f"{root}/daily"
    publish.load_star(
        spark,
        warehouse,
        fx.customers(spark, d),
        fx.products(spark, d),
        fx.single_product_orders(spark, d),
    )
    full = publish.read_star(spark, warehouse)
    late = (F.col("date_key") >= date_key(F.lit(LATE_FROM))) | (F.col("order_id") % 5 == 0)

    def of(condition: Column) -> Star:
        return replace(full, fact_orders=full.fact_orders.filter(condition))

    publish.refresh_daily_sales(spark, daily, of(~late))
    publish.add_daily_sales(spark, daily, of(late & (F.col("order_id") % 2 == 0)))
    publish.add_daily_sales(spark, daily, of(late & (F.col("order_id") % 2 == 1)))
    return publish.read_daily_sales(spark, daily)


def _daily_sales_of_changed_months(spark: SparkSession, d: str) -> DataFrame:
    root = shared_folder(spark)
    warehouse, daily = f"{root}/warehouse", f"{root}/daily"
    customers, products = fx.customers(spark, d), fx.products(spark, d)
    orders = staged(fx.single_product_orders(spark, d), f"{root}/orders")
    early = orders.filter(F.col("order_date") < F.lit(LATE_FROM))
    late = orders.filter(F.col("order_date") >= F.lit(LATE_FROM))
    publish.load_star(spark, warehouse, customers, products, early)
    publish.refresh_daily_sales(spark, daily, publish.read_star(spark, warehouse))
    publish.load_star(spark, warehouse, customers, products, orders)
    # One row per month: the calendar bounds it.
    months = late.select(F.trunc("order_date", "MM").alias("m")).distinct().collect()
    publish.refresh_daily_sales(
        spark, daily, publish.read_star(spark, warehouse), [r["m"] for r in months]
    )
    return publish.read_daily_sales(spark, daily)


def _operational_load(spark: SparkSession, d: str) -> DataFrame:
    root = shared_folder(spark)
    publish.load_operational(
        spark, root, fx.customers_raw(spark, d), fx.products_raw(spark, d), fx.orders_raw(spark, d)
    )
    return publish.load_summary(spark, root).select("tbl", "row_count")


def _load_with_payments(spark: SparkSession, d: str) -> DataFrame:
    root = shared_folder(spark)
    raw = fx.customers_raw(spark, d), fx.products_raw(spark, d), fx.orders_raw(spark, d)
    publish.load_operational(spark, root, *raw, fx.payments_raw(spark, d))
    return publish.read_table(spark, root, "payments")


def _csv_customers(spark: SparkSession, d: str) -> DataFrame:
    """The customer feed written as CSV files, read back and cleaned by file position."""
    path = f"{shared_folder(spark)}/customers_raw"
    raw = fx.customers_raw(spark, d).withColumn("_n", F.col("customer_id").cast("bigint"))
    # Files in id order, so that position and id agree on which email came first.
    ordered = raw.repartitionByRange("_n").sortWithinPartitions("_n")
    ordered.drop("_n", feeds.POSITION).write.option(
        "header", True
    ).csv(path)
    feed = feeds.read_feed(spark, path, RAW_CUSTOMERS, position=True)
    return cleaning.clean_customers(feed)[0]


def _null_words(spark: SparkSession, d: str) -> DataFrame:
    """Customers from CSV files in which words stand for "no value", in turn."""
    path = f"{shared_folder(spark)}/customers_raw"
    words = F.array(*[F.lit(w) for w in NULL_WORDS])
    key = F.col("customer_id").cast("bigint")
    word = F.element_at(words, (key % len(NULL_WORDS) + 1).cast("int"))
    raw = fx.customers_raw(spark, d).withColumns(
        {
            "city": F.when(key % 3 == 1, word).otherwise(F.col("city")),
            "signup_date": F.when(key % 3 == 2, word).otherwise(F.col("signup_date")),
        }
    )
    # Cells go to the file as they are, spaces too.
    kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    raw.drop(feeds.POSITION).write.option("header", True).options(**kept).csv(path)
    return feeds.read_feed(spark, path, RAW_CUSTOMERS)


def _refused_loads(spark: SparkSession, d: str) -> DataFrame:
    """Loads that break a rule of the star, and what readers see after each of them."""
    root = shared_folder(spark)
    customers, products = fx.customers(spark, d), fx.products(spark, d)
    heads = fx.payments(spark, d).select("order_id")
    orders = fx.order_headers(spark, d).join(heads, "order_id").select(
        "order_id", "customer_id", F.lit(1).cast("bigint").alias("product_id"),
        F.lit(1).alias("quantity"), "order_date", "status",
    )
    publish.load_star(spark, root, customers, products, orders)
    bad = {
        "no orders": (customers, products, orders.filter("false")),
        "unknown customer": (customers.filter("customer_id % 7 <> 3"), products, orders),
        "unknown product": (customers, products.filter("product_id <> 1"), orders),
        "repeated order": (customers, products, orders.unionByName(orders)),
    }
    seen = []
    for name, tables in bad.items():
        try:
            publish.load_star(spark, root, *tables)
            refused = False
        except (star.IntegrityError, constraints.ConstraintError):
            refused = True
        summary = publish.load_summary(spark, root).filter("tbl = 'fact_orders'")
        seen.append(summary.select(F.lit(name).alias("load"), F.lit(refused).alias("refused"), "row_count"))
    return reduce(DataFrame.unionByName, seen)


def _sales_of_a_quarter(spark: SparkSession, d: str) -> DataFrame:
    """Daily sales of one quarter of a stored star, whose other months are not read."""
    full = publish.read_star(spark, _loaded(spark, d))
    quarter = (F.col("year") == 1996) & (F.col("quarter") == 2)
    return metrics.daily_sales(metrics.of_days(full, quarter))


def _file_order_ids(spark: SparkSession, d: str) -> DataFrame:
    """Products written as CSV files without ids, which they get back from file order."""
    path = f"{shared_folder(spark)}/products"
    columns = ("title", "category", "price")
    fx.products(spark, d).repartitionByRange("product_id").sortWithinPartitions(
        "product_id"
    ).select(*columns).write.option("header", True).csv(path)
    feed = feeds.read_feed(spark, path, columns, position=True)
    return feeds.with_file_ids(feed, "product_id").withColumn("price", price(F.col("price")))


def _dead_letter_csv(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_folder(spark)}/dead_letter"
    rejects = _dead_letter(spark, d)
    path = sinks.write_dead_letter(rejects, path)
    # CSV columns go by place; the one the folders are named by comes last.
    columns = [c for c in rejects.columns if c != "source_table"] + ["source_table"]
    schema = ", ".join(f"{c} string" for c in columns)
    stored = spark.read.schema(schema).option("header", True).csv(path)
    return stored.select(*rejects.columns)


def _report_files(spark: SparkSession, d: str, section: str = "mom_revenue") -> DataFrame:
    """One section of the stored report."""
    path = f"{shared_folder(spark)}/report"
    sections = reports.sales_report(
        fx.customers(spark, d), fx.products(spark, d), fx.orders(spark, d)
    )
    path = sinks.write_report(sections, path, "parquet")
    return spark.read.parquet(f"{path}/report={section}")


def _kpi_file(spark: SparkSession, d: str) -> DataFrame:
    path = shared_folder(spark)
    path = sinks.write_analytics(fixture_star(spark, d), path)
    schema = (
        "total_revenue decimal(28,2), total_customers bigint, total_orders bigint, "
        "best_category string, repeat_customer_rate_pct decimal(18,2)"
    )
    return spark.read.schema(schema).json(f"{path}/summary_stats")


def _chart_files(spark: SparkSession, d: str) -> DataFrame:
    """The monthly series as it was written for the line chart."""
    path = sinks.write_analytics(fixture_star(spark, d), shared_folder(spark))
    schema = "month string, total_revenue decimal(28,2)"
    stored = spark.read.schema(schema).option("header", True)
    return stored.csv(f"{path}/charts/report=monthly_revenue")


def _dense_payment_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Payments numbered 1, 2, 3 ... by date and id, as an identity column would."""
    payments = fx.payments(spark, d).select("payment_id", "payment_date")
    return row_numbers(
        payments,
        "payment_number",
        order_by=["payment_id"],
        levels=[F.col("payment_date"), spread_blocks(payments, "payment_id")],
    )


def _views_in_sql(spark: SparkSession, d: str) -> DataFrame:
    """Big spenders by city, asked of the views in SQL."""
    metrics.create_views(fixture_star(spark, d), AS_OF)
    return spark.sql(
        """
        SELECT s.city, count(*) AS customers, sum(s.order_count) AS orders,
               count(r.customer_id) AS repeaters, max(s.days_since_last_order) AS longest_pause
        FROM vw_customer_summary s LEFT JOIN vw_repeat_customers r USING (customer_id)
        GROUP BY s.city
        """
    )


def _stored_views(spark: SparkSession, d: str) -> DataFrame:
    """The same of stored views, after another version was published and old ones removed."""
    root = shared_folder(spark)
    customers, products = fx.customers(spark, d), fx.products(spark, d)
    orders = staged(fx.single_product_orders(spark, d), f"{shared_folder(spark)}/orders")
    publish.load_star(spark, root, customers, products, orders)
    views.store_views(spark, root, as_of=AS_OF)
    few = orders.filter("order_id % 3 = 1")
    for _ in range(2):
        publish.load_star(spark, root, customers, products, few)
    versions.remove_old(spark, root, keep=1, older_than=-1)
    return spark.sql(
        """
        SELECT s.city, count(*) AS customers, sum(s.order_count) AS orders,
               count(r.customer_id) AS repeaters, max(s.days_since_last_order) AS longest_pause
        FROM default.vw_customer_summary s
        LEFT JOIN default.vw_repeat_customers r USING (customer_id)
        GROUP BY s.city
        """
    )


def _ids(df: DataFrame, name: str) -> DataFrame:
    return df.select(F.col(name).alias("id"))


def _made_orders(spark: SparkSession, d: str) -> DataFrame:
    """Made orders for the keys of the orders table, over as many customers and products."""
    customers, products = fx.customers(spark, d), fx.products(spark, d)
    return generate.make_orders(
        _ids(fx.order_headers(spark, d), "order_id"),
        customers=customers.agg(F.count(F.lit(1))).scalar(),
        products=products.agg(F.count(F.lit(1))).scalar(),
        today=AS_OF,
    )


def _planted_faults_found(spark: SparkSession, d: str) -> DataFrame:
    """Planted faults found again: generated dirt through the cleaning rules."""
    customers = cleaning.clean_customers(generate.dirty_customers(fx.customers(spark, d)))
    products = cleaning.clean_products(generate.dirty_products(fx.products(spark, d)))
    orders = cleaning.clean_orders(
        generate.dirty_orders(fx.single_product_orders(spark, d)), customers[0], products[0]
    )
    return cleaning.reason_counts(cleaning.dead_letter(customers[1], products[1], orders[1]))


QUERIES: dict[str, Query] = {
    "q01_revenue_by_category": lambda s, d: sales.revenue_by_category(
        fx.orders(s, d), fx.products(s, d)
    ),
    "q02_top_customers_by_payments": lambda s, d: sales.top_customers_by_payments(
        fx.customers(s, d), fx.order_headers(s, d), fx.payments(s, d)
    ),
    "q03_monthly_payments": lambda s, d: sales.monthly_payments(
        fx.payments(s, d), fx.order_headers(s, d)
    ),
    "q04_popular_products": lambda s, d: sales.popular_products(
        fx.products(s, d), fx.orders(s, d)
    ),
    "q05_customer_rank_in_city": lambda s, d: sales.customer_rank_in_city(
        fx.customers(s, d), fx.order_headers(s, d), fx.payments(s, d)
    ),
    "q06_running_revenue": lambda s, d: sales.running_revenue(fx.payments(s, d)),
    "q07_payment_vs_previous": lambda s, d: sales.payment_vs_previous(fx.payments(s, d)),
    "q08_payment_vs_next": lambda s, d: sales.payment_vs_next(fx.payments(s, d)),
    "q09_order_sequence": lambda s, d: sales.order_sequence(
        fx.order_headers(s, d), fx.customers(s, d)
    ),
    "q10_order_sizes": lambda s, d: sales.order_sizes(
        fx.orders(s, d),
        fx.customers(s, d),
        fx.products(s, d),
        fx.payments(s, d),
        bands=SIZE_BANDS,
    ),
    "q11_never_completed": lambda s, d: sales.never_completed(
        fx.customers(s, d), fx.order_headers(s, d)
    ),
    "q12_preferred_payment_method": lambda s, d: sales.preferred_payment_method(
        fx.customers(s, d), fx.order_headers(s, d), fx.payments(s, d)
    ),
    "q13_return_rates": lambda s, d: sales.return_rates(
        fx.products(s, d), fx.orders(s, d), risk_pct=RISK_PCT
    ),
    "r01_category_revenue": lambda s, d: reports.category_revenue(
        fx.orders(s, d), fx.products(s, d)
    ),
    "r02_top_customers": lambda s, d: reports.top_customers(
        fx.customers(s, d), fx.orders(s, d), fx.products(s, d)
    ),
    "r03_orders_by_status": lambda s, d: reports.orders_by_status(fx.orders(s, d)),
    "r04_month_over_month": lambda s, d: reports.month_over_month(
        fx.orders(s, d), fx.products(s, d)
    ),
    "star_dim_customers": lambda s, d: star.dim_customers(fx.customers(s, d)),
    "star_dim_products": lambda s, d: star.dim_products(fx.products(s, d)),
    "star_dim_date": lambda s, d: star.dim_date(fx.orders(s, d)),
    "star_fact_orders": lambda s, d: fixture_star(s, d, numbered=True).fact_orders,
    "star_fact_of_clean_orders": lambda s, d: star.fact_orders(
        _orders_clean(s, d)[0], _products_clean(s, d)[0], dense_keys=True
    ),
    "star_unresolved_keys": _unresolved,
    "star_unresolved_rows": _unresolved_rows,
    "star_constraints": _star_rules,
    "v01_monthly_revenue": lambda s, d: metrics.monthly_revenue(fixture_star(s, d)),
    "v02_category_performance": lambda s, d: metrics.category_performance(fixture_star(s, d)),
    "v03_customer_summary": lambda s, d: metrics.customer_summary(fixture_star(s, d), AS_OF),
    "v04_repeat_customers": lambda s, d: metrics.repeat_customers(fixture_star(s, d)),
    "v05_daily_sales": lambda s, d: metrics.daily_sales(fixture_star(s, d)),
    "n01_kpi_summary": lambda s, d: metrics.kpi_summary(fixture_star(s, d)),
    "n02_row_counts": _row_counts,
    "n03_load_verification": _load_verification,
    "chart_monthly": lambda s, d: metrics.chart_series(fixture_star(s, d))["monthly_revenue"],
    "chart_category": lambda s, d: metrics.chart_series(fixture_star(s, d))["category_revenue"],
    "chart_top10": lambda s, d: metrics.chart_series(fixture_star(s, d))["top_customers"],
    "views_in_sql": _views_in_sql,
    "views_stored": _stored_views,
    "daily_sales_stored": _stored_daily_sales,
    "daily_sales_incremental": _incremental_daily_sales,
    "daily_sales_changed_months": _daily_sales_of_changed_months,
    "dq_customers_clean": lambda s, d: _customers_clean(s, d)[0],
    "dq_customers_rejected": lambda s, d: _customers_clean(s, d)[1],
    "dq_products_clean": lambda s, d: _products_clean(s, d)[0],
    "dq_products_rejected": lambda s, d: _products_clean(s, d)[1],
    "dq_payments_clean": lambda s, d: _payments_clean(s, d)[0],
    "dq_payments_rejected": lambda s, d: _payments_clean(s, d)[1],
    "dq_orders_clean": lambda s, d: _orders_clean(s, d)[0],
    "dq_orders_broken_parents": _broken_parents,
    "dq_orders_rejected": lambda s, d: _orders_clean(s, d)[1],
    "dq_dead_letter": _dead_letter,
    "dq_reason_counts": lambda s, d: cleaning.reason_counts(_dead_letter(s, d)),
    "dq_key_rules": _key_rules,
    "dq_load_counts": _load_counts,
    "dq_payments_load": _load_with_payments,
    "dq_operational_load": _operational_load,
    "dq_constraints_nulls": _nulls,
    "dq_constraints_samples": _rule_samples,
    "dq_constraints_unique": _unique,
    "dq_constraints_check": _checks,
    "dq_constraints_fk": _foreign_keys,
    "dq_constraints_width": _widths,
    "dq_constraints_all": _operational,
    "dq_duplicate_email_rows": lambda s, d: constraints.unique_violation_rows(
        _customers_typed(s, d), ["email"]
    ),
    "dq_orphan_order_rows": lambda s, d: constraints.foreign_key_violation_rows(
        _orders_typed(s, d), "customer_id", fx.customers(s, d)
    ),
    "ordered_dense_numbers": _dense_payment_numbers,
    "src_csv_customers": _csv_customers,
    "src_file_order_ids": _file_order_ids,
    "src_csv_null_words": _null_words,
    "star_refused_loads": _refused_loads,
    "v05_daily_sales_of_a_quarter": _sales_of_a_quarter,
    "sink_dead_letter_csv": _dead_letter_csv,
    "sink_report": _report_files,
    "sink_report_revenue_by_category": partial(_report_files, section="revenue_by_category"),
    "sink_report_top_customers": partial(_report_files, section="top_customers"),
    "sink_report_orders_by_status": partial(_report_files, section="orders_by_status"),
    "sink_chart_files": _chart_files,
    "sink_kpi_json": _kpi_file,
    "gen_customers": lambda s, d: generate.make_customers(
        _ids(fx.customers(s, d), "customer_id"), today=AS_OF
    ),
    "gen_products": lambda s, d: generate.make_products(_ids(fx.products(s, d), "product_id")),
    "gen_orders": _made_orders,
    "gen_dirty_customers": lambda s, d: generate.dirty_customers(fx.customers(s, d)),
    "gen_dirty_products": lambda s, d: generate.dirty_products(fx.products(s, d)),
    "gen_dirty_orders": lambda s, d: generate.dirty_orders(fx.single_product_orders(s, d)),
    "gen_reason_counts": _planted_faults_found,
}
