"""Cleaning of raw feeds: rows that break a rule go to the dead letter with the reasons.

Each feed becomes one annotated table with three columns: ``raw`` (the row as it
came), ``typed`` (trimmed and cast) and ``reasons`` (empty if the row is good).
The accepted and the rejected rows are two filters of it, so a job can write it
once and read it twice.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.functions.casts import number, price, strict_date, whole_number
from tillwork.functions.text import cell, email_ok
from tillwork.model import (
    RAW_CUSTOMERS,
    RAW_ORDERS,
    RAW_PAYMENTS,
    RAW_PRODUCTS,
    STATUSES,
    TEXT_LIMITS,
)
from tillwork.operators.hot import spread
from tillwork.operators.members import mark_members
from tillwork.sources.feeds import POSITION, positioned

# Rows without a usable key take no part in the search for duplicates. They get one
# of this many join keys, none of which can be a key.
_FILLERS = 4096
# Repeated keys that may become part of a plan.
_FEW = 10_000


def _raw(columns: Sequence[str]) -> Column:
    return F.struct(*columns).alias("raw")


def _joined(*reasons: Column) -> Column:
    return F.concat_ws("; ", *reasons).alias("reasons")


def accepted(annotated: DataFrame) -> DataFrame:
    return annotated.filter(F.col("reasons") == "").select("typed.*")


def rejected(annotated: DataFrame, source: str) -> DataFrame:
    """The raw rows that broke a rule, with the feed's name and the reasons."""
    return annotated.filter(F.col("reasons") != "").select(
        "raw.*",
        F.lit(source).alias("source_table"),
        F.col("reasons").alias("rejection_reason"),
    )


def dead_letter(*rejects: DataFrame) -> DataFrame:
    """Rejected rows of several feeds in one table; columns a feed lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rejects)


def _placed(raw: DataFrame, key: Column) -> tuple[DataFrame, Column, str]:
    """A feed and what orders its rows: the place it came with, else the id and then a number
    that is written before it is used, as several passes must agree on it. Last, the part of
    it that orders the rows of one id."""
    if POSITION in raw.columns:
        return raw, F.col(POSITION).alias("_pos"), "_pos"
    placed = F.struct(key.alias("id"), F.col(POSITION).alias("row"))
    return positioned(raw), placed.alias("_pos"), "_pos.row"


def _settled(few: DataFrame) -> DataFrame:
    """A table that usually has few rows or none, looked at before the plan is made.

    Up to ``_FEW`` rows become part of the plan: then Spark knows the size of a join's side,
    and leaves out a join with none. A larger table stays as it is.
    """
    rows = few.limit(_FEW + 1).collect()
    if len(rows) > _FEW:
        return few
    # Of rows made from a list Spark does not know how many there are: it would shuffle the
    # feed to join it with none.
    return few.sparkSession.createDataFrame(rows, few.schema) if rows else few.limit(0)


def _firsts(parsed: DataFrame, key: Column, good: Column, place: str = "_pos") -> DataFrame:
    """The first good row of each key that several rows have; the keys as text.

    ``place`` is what orders the rows of one key. Ids are grouped as numbers, and by a number if
    the place has one: texts and structs would have all rows sorted, not hashed.
    """
    first = F.col("_first")
    if place != "_pos":
        in_full = F.struct(F.col("_key").alias("id"), first.alias("row"))
        first = F.when(first.isNotNull(), in_full).alias("_first")
    return _settled(
        parsed.filter(key.isNotNull())
        .select(key.alias("_key"), F.col(place).alias("_place"), good.alias("_good"))
        .groupBy("_key", spread("_key"))
        .agg(
            F.min(F.when(F.col("_good"), F.col("_place"))).alias("_first"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter(F.col("_n") > 1)
        .select(F.col("_key").cast("string").alias("_key"), first)
    )


def _mark_later(rows: DataFrame, firsts: DataFrame, key: Column, out: str) -> DataFrame:
    """Adds ``out``: whether a good row with the same key, which is text, comes earlier."""
    # Rows without a key get join keys that no key can be, so that they do not all meet.
    filler = F.concat(F.lit(" "), F.pmod(F.xxhash64("raw"), F.lit(_FILLERS)).cast("string"))
    keyed = rows.withColumn("_key", F.coalesce(key, filler))
    later = F.coalesce(F.col("_pos") > F.col("_first"), F.lit(False))
    return keyed.join(firsts, "_key", "left").withColumn(out, later).drop("_key", "_first")


def _too_long(table: str) -> dict[str, Column]:
    """Whether each text of ``typed`` is longer than its column, by name."""
    return {c: F.length(f"typed.{c}") > n for c, n in TEXT_LIMITS[table].items()}


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda x, y: x | y, (F.coalesce(c, F.lit(False)) for c in conditions))


def annotate_customers(raw: DataFrame) -> DataFrame:
    """Of several good rows with the same id, the first is accepted; of those left with the
    same email, whatever its case, again the first.

    First means by the position ``read_feed`` attached, else by the customer id and a number
    given to the rows, which are written for that. A row rejected for another reason reserves
    neither.
    """
    key = whole_number(cell(F.col("customer_id")))
    signup_text = cell(F.col("signup_date"))
    raw, place, row = _placed(raw, key)
    parsed = raw.select(
        _raw(RAW_CUSTOMERS),
        F.struct(
            key.alias("customer_id"),
            cell(F.col("full_name")).alias("full_name"),
            cell(F.col("email")).alias("email"),
            cell(F.col("city")).alias("city"),
            strict_date(signup_text).alias("signup_date"),
        ).alias("typed"),
        place,
        signup_text.alias("_signup"),
    )
    email = F.col("typed.email")
    usable = email_ok(email)
    no_name = F.col("typed.full_name") == ""
    no_city = F.col("typed.city") == ""
    bad_signup = (F.col("_signup") != "") & F.col("typed.signup_date").isNull()
    bad_key = F.col("typed.customer_id").isNull()
    long = _too_long("customers")
    good = ~_any([no_name, no_city, bad_signup, bad_key, ~usable, *long.values()])
    ids, email_text = F.col("typed.customer_id"), F.when(usable, F.lower(email))
    firsts = _firsts(parsed, ids, good, row)
    marked = _mark_later(parsed, firsts, ids.cast("string"), "_again")
    reserving = _firsts(marked, email_text, good & ~F.col("_again"))
    marked = _mark_later(marked, reserving, email_text, "_used")
    return marked.select(
        "raw",
        "typed",
        _joined(
            F.when(no_name, "missing full_name"),
            F.when(email == "", "missing email")
            .when(~usable, "invalid email format")
            .when(F.col("_used"), "duplicate email"),
            F.when(no_city, "missing city"),
            F.when(bad_signup, "invalid signup_date"),
            F.when(bad_key, "invalid customer_id").when(F.col("_again"), "duplicate customer_id"),
            *[F.when(is_long, f"{c} too long") for c, is_long in long.items()],
        ),
    )


def annotate_products(raw: DataFrame) -> DataFrame:
    """Prices are rounded to cents, half up, and must then be positive. Of several good rows
    with the same id, the first is accepted, as for customers."""
    price_text = cell(F.col("price"))
    key = whole_number(cell(F.col("product_id")))
    raw, place, row = _placed(raw, key)
    parsed = raw.select(
        _raw(RAW_PRODUCTS),
        F.struct(
            key.alias("product_id"),
            cell(F.col("title")).alias("title"),
            cell(F.col("category")).alias("category"),
            price(price_text).alias("price"),
        ).alias("typed"),
        place,
        number(price_text).alias("_amount"),
    )
    amount, cents = F.col("_amount"), F.col("typed.price")
    no_title, no_category = F.col("typed.title") == "", F.col("typed.category") == ""
    bad_key = F.col("typed.product_id").isNull()
    long = _too_long("products")
    good = ~_any([no_title, no_category, bad_key, cents.isNull(), cents <= 0, *long.values()])
    ids = F.col("typed.product_id")
    marked = _mark_later(parsed, _firsts(parsed, ids, good, row), ids.cast("string"), "_again")
    return marked.select(
        "raw",
        "typed",
        _joined(
            F.when(amount.isNull(), "invalid price")
            .when((amount <= 0) | (cents <= 0), "price must be positive")
            .when(cents.isNull(), "invalid price"),
            F.when(no_title, "missing title"),
            F.when(no_category, "missing category"),
            F.when(bad_key, "invalid product_id").when(F.col("_again"), "duplicate product_id"),
            *[F.when(is_long, f"{c} too long") for c, is_long in long.items()],
        ),
    )


def annotate_orders(raw: DataFrame, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Rejecting a parent rejects its orders: ``customers`` and ``products`` are accepted rows.

    Of several rows with the same id whose own cells are good, the first stands, as for
    customers, whether or not its parents exist.
    """
    customer = whole_number(cell(F.col("customer_id")))
    product = whole_number(cell(F.col("product_id")))
    raw, place, row = _placed(raw, whole_number(cell(F.col("order_id"))))
    parsed = raw.select(
        _raw(RAW_ORDERS),
        F.struct(
            whole_number(cell(F.col("order_id"))).alias("order_id"),
            customer.alias("customer_id"),
            product.alias("product_id"),
            whole_number(cell(F.col("quantity")), "int").alias("quantity"),
            strict_date(cell(F.col("order_date"))).alias("order_date"),
            cell(F.col("status")).alias("status"),
        ).alias("typed"),
        place,
        customer.alias("_customer"),
        product.alias("_product"),
    )
    quantity = F.col("typed.quantity")
    bad_quantity = quantity.isNull() | (quantity <= 0)
    bad_status = ~F.col("typed.status").isin(*STATUSES)
    bad_date = F.col("typed.order_date").isNull()
    good = ~_any([bad_quantity, bad_status, bad_date])
    known = mark_members(parsed, "_customer", customers, "customer_id", "_buyer")
    known = mark_members(known, "_product", products, "product_id", "_item")
    # Joined last: the joins with the parents, which may be uneven, read the feed itself.
    ids = F.col("typed.order_id")
    known = _mark_later(known, _firsts(parsed, ids, good, row), ids.cast("string"), "_again")
    return known.select(
        "raw",
        "typed",
        _joined(
            F.when(quantity.isNull(), "invalid quantity").when(
                quantity <= 0, "quantity must be positive"
            ),
            F.when(bad_status, "invalid status"),
            F.when(bad_date, "invalid order_date"),
            F.when(F.col("_customer").isNull(), "invalid customer_id").when(
                F.col("_buyer").isNull(), "customer_id not found"
            ),
            F.when(F.col("_product").isNull(), "invalid product_id").when(
                F.col("_item").isNull(), "product_id not found"
            ),
            F.when(F.col("typed.order_id").isNull(), "invalid order_id").when(
                F.col("_again"), "duplicate order_id"
            ),
        ),
    )


def annotate_payments(raw: DataFrame, orders: DataFrame) -> DataFrame:
    """Rejecting an order rejects its payments: ``orders`` are accepted rows.

    Amounts are rounded to cents, half up, and must then be positive. Of several good
    rows with the same id the first stands.
    """
    amount_text = cell(F.col("amount"))
    key = whole_number(cell(F.col("payment_id").cast("string")))
    order = whole_number(cell(F.col("order_id")))
    cells = [F.col(c).cast("string").alias(c) for c in RAW_PAYMENTS]
    raw, place, row = _placed(raw, key)
    parsed = raw.select(
        F.struct(*cells).alias("raw"),
        F.struct(
            key.alias("payment_id"),
            order.alias("order_id"),
            strict_date(cell(F.col("payment_date"))).alias("payment_date"),
            price(amount_text).alias("amount"),
            cell(F.col("method")).alias("method"),
        ).alias("typed"),
        place,
        number(amount_text).alias("_amount"),
        order.alias("_order"),
    )
    amount, cents = F.col("_amount"), F.col("typed.amount")
    bad_date = F.col("typed.payment_date").isNull()
    no_method = F.col("typed.method") == ""
    long = _too_long("payments")
    good = ~_any([cents.isNull(), cents <= 0, bad_date, no_method, *long.values()])
    known = mark_members(parsed, "_order", orders, "order_id", "_found")
    ids = F.col("typed.payment_id")
    known = _mark_later(known, _firsts(parsed, ids, good, row), ids.cast("string"), "_again")
    return known.select(
        "raw",
        "typed",
        _joined(
            F.when(amount.isNull(), "invalid amount")
            .when((amount <= 0) | (cents <= 0), "amount must be positive")
            .when(cents.isNull(), "invalid amount"),
            F.when(no_method, "missing method"),
            F.when(bad_date, "invalid payment_date"),
            F.when(F.col("_order").isNull(), "invalid order_id").when(
                F.col("_found").isNull(), "order_id not found"
            ),
            F.when(F.col("typed.payment_id").isNull(), "invalid payment_id").when(
                F.col("_again"), "duplicate payment_id"
            ),
            *[F.when(is_long, f"{c} too long") for c, is_long in long.items()],
        ),
    )


def clean_customers(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)"""
    annotated = annotate_customers(raw)
    return accepted(annotated), rejected(annotated, "customers")


def clean_products(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected)"""
    annotated = annotate_products(raw)
    return accepted(annotated), rejected(annotated, "products")


def clean_orders(
    raw: DataFrame, customers: DataFrame, products: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected), with the accepted customers and products as parents."""
    annotated = annotate_orders(raw, customers, products)
    return accepted(annotated), rejected(annotated, "orders")


def clean_payments(raw: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected), with the accepted orders as parents."""
    annotated = annotate_payments(raw, orders)
    return accepted(annotated), rejected(annotated, "payments")


def reason_counts(rejects: DataFrame) -> DataFrame:
    """Rows per source and single reason; a row with two reasons counts under both."""
    # Counted before it is split: there are few different combinations of reasons.
    combined = rejects.groupBy("source_table", "rejection_reason").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    return (
        combined.withColumn("reason", F.explode(F.split("rejection_reason", "; ")))
        .groupBy("source_table", "reason")
        .agg(F.sum("_rows").alias("row_count"))
    )


def load_counts(annotated: dict[str, DataFrame]) -> DataFrame:
    """Accepted rows per table, and the rejected rows of all feeds together.

    Takes the annotated tables, each of which is read once for both numbers.
    """
    good = F.count_if(F.col("reasons") == "").alias("accepted")
    bad = F.count_if(F.col("reasons") != "").alias("rejected")
    parts = [df.agg(F.lit(name).alias("tbl"), good, bad) for name, df in annotated.items()]
    counts = reduce(DataFrame.unionByName, parts).unpivot(
        ["tbl"], ["accepted", "rejected"], "kind", "n"
    )
    label = F.when(F.col("kind") == "rejected", "rejected").otherwise(F.col("tbl"))
    return counts.groupBy(label.alias("tbl")).agg(F.sum("n").alias("row_count"))
