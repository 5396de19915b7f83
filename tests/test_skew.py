"""Joins at full size: no side may be broadcast, and one key holds a large part of the rows.

Each result is compared with plain loops, and each plan must show that adaptive
execution split the hot partition.
"""

import random
from collections import Counter, defaultdict
from datetime import date
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.model import RAW_CUSTOMERS, RAW_ORDERS
from tillwork.operators import members
from tillwork.plans import cleaning, constraints, sales, star

DAY = date(2025, 1, 1)
N = 30_000


@pytest.fixture(autouse=True)
def full_size(setting):
    for key, value in {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    }.items():
        setting(key, value)


def _run(df):
    """All rows, after checking that a skewed join was split."""
    rows = tuples(df)
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    return rows


@pytest.fixture(scope="module")
def shop(spark):
    """Most of the payments belong to order 7: equal rows shrink, and bytes decide on a split."""
    r = random.Random(2)
    orders = [(i, r.randrange(1, 50), i % 5, DAY, "completed", 1) for i in range(2_000)]
    paid = [(n, 7 if n % 6 else r.randrange(2_000), r.choice("abc")) for n in range(N)]
    o = spark.createDataFrame(
        orders,
        "order_id bigint, customer_id bigint, product_id bigint, order_date date, "
        "status string, quantity int",
    )
    y = (
        spark.createDataFrame(paid, "payment_id bigint, order_id bigint, method string")
        .withColumn("payment_date", F.lit(DAY))
        .withColumn("amount", F.lit(D("2.00")).cast("decimal(10,2)"))
        .repartition(8)
    )
    c = spark.range(1, 50).select(
        F.col("id").alias("customer_id"),
        F.concat(F.lit("n"), "id").alias("full_name"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("city"),
    )
    return {i: c for i, c, *_ in orders}, paid, c, o, y


def test_monthly_payments(shop):
    _, _, _, orders, payments = shop
    assert _run(sales.monthly_payments(payments, orders)) == [("Jan 2025", N, D(2 * N))]


def test_preferred_payment_method(shop):
    owner, paid, customers, orders, payments = shop
    uses = Counter((f"c{owner[oid] % 4}", m) for _, oid, m in paid)
    best = defaultdict(int)
    for (city, _), n in uses.items():
        best[city] = max(best[city], n)
    expected = sorted((c, m, n) for (c, m), n in uses.items() if n == best[c])
    assert _run(sales.preferred_payment_method(customers, orders, payments)) == expected


def test_rank_in_city_sums_before_it_joins(shop):
    owner, paid, customers, orders, payments = shop
    spent = Counter()
    for _, oid, _ in paid:
        spent[owner[oid]] += 2
    ranked = tuples(sales.customer_rank_in_city(customers, orders, payments, ordered=False))
    assert len(ranked) == len(spent)
    for city, name, total, rank in ranked:
        rivals = [v for c, v in spent.items() if f"c{c % 4}" == city]
        assert total == spent[int(name[1:])]
        assert rank == 1 + sum(v > total for v in rivals)


def test_order_sizes(spark, shop):
    _, paid, customers, orders, payments = shop
    products = spark.range(5).select(
        F.col("id").alias("product_id"), F.concat(F.lit("p"), "id").alias("title")
    )
    sizes = sales.order_sizes(orders, customers, products, payments, ordered=False)
    assert Counter(r[0] for r in _run(sizes)) == Counter(oid for _, oid, _ in paid)


def test_fact_with_a_hot_product(spark):
    orders = (
        spark.range(N)
        .select(
            F.col("id").alias("order_id"),
            F.col("id").alias("customer_id"),
            F.when(F.col("id") % 2 == 0, 3).otherwise(F.col("id") % 500).alias("product_id"),
            F.lit(2).alias("quantity"),
            F.lit(DAY).alias("order_date"),
            F.lit("pending").alias("status"),
        )
        .repartition(8)
    )
    products = spark.range(400).select(
        F.col("id").alias("product_id"), F.col("id").cast("decimal(10,2)").alias("price")
    )
    fact = star.fact_orders(orders, products)
    rows = _run(fact.select("order_id", "product_key", "total_amount"))
    assert len(rows) == N
    for i, product, total in rows:
        expected = 3 if i % 2 == 0 else i % 500
        assert (product, total) == ((expected, 2 * expected) if expected < 400 else (None, None))


def test_one_email_in_a_third_of_the_rows(spark):
    ids = spark.range(N).repartition(8)
    email = F.when(F.col("id") % 3 == 1, "Hot@x.org").otherwise(
        F.concat(F.lit("u"), F.col("id").cast("string"), F.lit("@x.org"))
    )
    feed = ids.select(
        F.col("id").cast("string").alias("customer_id"),
        F.md5(F.col("id").cast("string").cast("binary")).alias("full_name"),
        email.alias("email"),
        F.lit("Rome").alias("city"),
        F.lit(None).cast("string").alias("signup_date"),
    ).select(*RAW_CUSTOMERS)
    rows = _run(cleaning.annotate_customers(feed).select("typed.customer_id", "reasons"))
    assert len(rows) == N
    for i, reasons in rows:
        assert reasons == ("duplicate email" if i % 3 == 1 and i > 1 else "")


def test_unknown_customer_and_hot_product_in_a_third_of_the_orders(spark, monkeypatch):
    # As with parents whose ids lie too far apart for every task to hold their bits.
    monkeypatch.setattr(members, "MOST_ROWS", 0)
    ids = spark.range(N).repartition(8)
    third = F.col("id") % 3
    number = F.col("id").cast("string")
    feed = ids.select(
        number.alias("order_id"),
        F.when(third == 0, "99999999").otherwise(number).alias("customer_id"),
        F.when(third == 1, "7").otherwise((F.col("id") % 90).cast("string")).alias("product_id"),
        F.lit("1").alias("quantity"),
        F.lit("2025-01-01").alias("order_date"),
        F.lit("pending").alias("status"),
    ).select(*RAW_ORDERS)
    customers = spark.range(N).select(F.col("id").alias("customer_id"))
    products = spark.range(80).select(F.col("id").alias("product_id"))
    annotated = cleaning.annotate_orders(
        feed, customers.unionByName(customers), products.unionByName(products)
    ).select("typed.order_id", "reasons")
    rows = tuples(annotated)
    plan = annotated._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[0].count("skew=true") == 2
    assert len(rows) == N
    for i, reasons in rows:
        expected = ["customer_id not found"] if i % 3 == 0 else []
        expected += ["product_id not found"] if i % 3 != 1 and i % 90 >= 80 else []
        assert reasons == "; ".join(expected)


def test_constraint_rows_of_a_hot_value(spark):
    rows = (
        spark.range(N)
        .select(
            F.col("id"),
            F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("parent"),
        )
        .repartition(8)
    )
    parents = spark.range(N).select(F.col("id").alias("parent"))
    orphans = constraints.foreign_key_violation_rows(rows, "parent", parents)
    assert len(_run(orphans)) == N // 2
    repeated = constraints.unique_violation_rows(rows, ["parent"])
    assert len(_run(repeated)) == N // 2
