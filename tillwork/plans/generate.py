"""Test feeds of any size, and planted faults at given rates.

Every value follows from the row's id and a salt through a hash, so the same rows
come out however the data is partitioned, and again when a lost task is re-run.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.model import PRICE, STATUSES
from tillwork.operators.ordered import id_levels, row_numbers

# Names of the made-up shop.
CITIES = ("Ashford", "Brackwater", "Corley", "Dunmere", "Eastholm", "Fennick", "Greywell")
CATEGORIES = ("lighting", "kitchen", "bedding", "storage", "wellness")
FIRST_NAMES = ("Ada", "Bram", "Cleo", "Dario", "Edda", "Falk", "Greta", "Hugo", "Iris")
LAST_NAMES = ("Abbot", "Barlow", "Crane", "Dalton", "Ellery", "Finch", "Garrow", "Hale")
THINGS = ("Lamp", "Kettle", "Cushion", "Serum", "Candle", "Basket", "Blanket", "Teapot")
LOOKS = ("Plain", "Bright", "Folding", "Woven", "Light", "Sturdy", "Round")


# The shares of faulty rows in the sample shop's feeds.
@dataclass(frozen=True)
class FaultRates:
    """Shares of rows that get each fault; faults of one field exclude each other."""

    no_name: float = 0.05
    no_email: float = 0.05
    bad_email: float = 0.05
    used_email: float = 0.05
    no_city: float = 0.05
    bad_signup: float = 0.05
    no_title: float = 0.05
    no_category: float = 0.05
    price_text: float = 0.04
    price_negative: float = 0.03
    price_zero: float = 0.02
    unknown_customer: float = 0.04
    unknown_product: float = 0.04
    quantity_zero: float = 0.03
    quantity_negative: float = 0.02
    quantity_text: float = 0.02
    bad_status: float = 0.05
    bad_date: float = 0.03


# Ids that no parent has, however many there are: keys count up from 0 or 1.
UNKNOWN_CUSTOMER = "-99999"
UNKNOWN_PRODUCT = "-88888"
# The texts that faulty rows carry.
BAD_STATUS = "shipped"
BAD_DATE = "2025-13-40"
BAD_SIGNUP = "not-a-date"


def draw(key: Column, salt: str) -> Column:
    """A whole number from 0 to 2^60 - 1, fixed by the key and the salt."""
    return F.conv(F.left(_digest(key, salt), F.lit(15)), 16, 10).cast("bigint")


def _digest(key: Column, salt: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(salt), key.cast("string")).cast("binary"))


def _roll(field: int) -> Column:
    """Four hex digits of the row's digest; each field of a row has its own four."""
    return F.substring("_digest", 4 * field + 1, 4)


def _below(roll: Column, *rates: float) -> Column:
    # Hex texts of one length compare like the numbers they stand for.
    limit = min(round(sum(rates) * 65_536), 65_536)
    return roll < (f"{limit:04x}" if limit < 65_536 else "g")


def _pick(key: Column, salt: str, values: tuple[str, ...]) -> Column:
    choices = F.array(*[F.lit(v) for v in values])
    return F.element_at(choices, (draw(key, salt) % len(values) + 1).cast("int"))


def dirty_customers(
    customers: DataFrame, rates: FaultRates = FaultRates(), seed: str = "42"
) -> DataFrame:
    """Text rows of ``customers`` with faults planted.

    A used email is the one of another customer with a lower id, chosen by hash among
    those that exist, whatever gaps their ids have.
    """
    key = F.col("customer_id")
    no_email = _below(_roll(1), rates.no_email)
    bad_email = _below(_roll(1), rates.no_email, rates.bad_email)
    takes_email = ~bad_email & _below(
        _roll(1), rates.no_email, rates.bad_email, rates.used_email
    )
    numbered = row_numbers(
        customers, "_nth", order_by=["customer_id"], levels=id_levels(customers, "customer_id")
    )
    before = F.col("_nth") - 1
    lender = F.when(takes_email & (before > 0), draw(key, f"{seed}lender") % before + 1)
    lenders = numbered.select(F.col("_nth").alias("_lender"), F.col("email").alias("_lent"))
    # Rows that take no email look for none: they are kept out of the join.
    rows = numbered.withColumn("_digest", _digest(key, seed)).withColumn("_lender", lender)
    takers = rows.filter(F.col("_lender").isNotNull()).join(lenders, "_lender", "left")
    others = rows.filter(F.col("_lender").isNull()).withColumn("_lent", F.lit(None).cast("string"))
    return takers.unionByName(others).select(
        key.cast("string").alias("customer_id"),
        F.when(_below(_roll(0), rates.no_name), "")
        .otherwise(F.col("full_name"))
        .alias("full_name"),
        F.when(no_email, "")
        .when(bad_email, F.replace(F.col("email"), F.lit("@"), F.lit("")))
        .otherwise(F.coalesce("_lent", "email"))
        .alias("email"),
        F.when(_below(_roll(2), rates.no_city), "")
        .otherwise(F.col("city"))
        .alias("city"),
        F.when(_below(_roll(3), rates.bad_signup), BAD_SIGNUP)
        .otherwise(F.col("signup_date").cast("string"))
        .alias("signup_date"),
    )


def dirty_products(
    products: DataFrame, rates: FaultRates = FaultRates(), seed: str = "42"
) -> DataFrame:
    """Text rows of ``products`` with faults planted."""
    key = F.col("product_id")
    roll = _roll(2)
    amount = F.col("price").cast(PRICE)
    return products.withColumn("_digest", _digest(key, seed)).select(
        key.cast("string").alias("product_id"),
        F.when(_below(_roll(0), rates.no_title), "")
        .otherwise(F.col("title"))
        .alias("title"),
        F.when(_below(_roll(1), rates.no_category), "")
        .otherwise(F.col("category"))
        .alias("category"),
        F.when(_below(roll, rates.price_text), "N/A")
        .when(_below(roll, rates.price_text, rates.price_negative), (-amount).cast("string"))
        .when(_below(roll, rates.price_text, rates.price_negative, rates.price_zero), "0")
        .otherwise(amount.cast("string"))
        .alias("price"),
    )


def dirty_orders(
    orders: DataFrame,
    rates: FaultRates = FaultRates(),
    seed: str = "42",
    *,
    unknown_customer: str = UNKNOWN_CUSTOMER,
    unknown_product: str = UNKNOWN_PRODUCT,
) -> DataFrame:
    """Text rows of ``orders`` with faults planted.

    The unknown ids must be no key of a parent.
    """
    key = F.col("order_id")
    roll = _roll(2)
    zero, negative = rates.quantity_zero, rates.quantity_negative
    return orders.withColumn("_digest", _digest(key, seed)).select(
        key.cast("string").alias("order_id"),
        F.when(_below(_roll(0), rates.unknown_customer), unknown_customer)
        .otherwise(F.col("customer_id").cast("string"))
        .alias("customer_id"),
        F.when(_below(_roll(1), rates.unknown_product), unknown_product)
        .otherwise(F.col("product_id").cast("string"))
        .alias("product_id"),
        F.when(_below(roll, zero), "0")
        .when(_below(roll, zero, negative), "-2")
        .when(_below(roll, zero, negative, rates.quantity_text), "two")
        .otherwise(F.col("quantity").cast("string"))
        .alias("quantity"),
        F.when(_below(_roll(3), rates.bad_date), BAD_DATE)
        .otherwise(F.col("order_date").cast("string"))
        .alias("order_date"),
        F.when(_below(_roll(4), rates.bad_status), BAD_STATUS)
        .otherwise(F.col("status"))
        .alias("status"),
    )


def _day_before(day: date, back: Column) -> Column:
    return F.date_sub(F.lit(day), back.cast("int"))


def make_customers(ids: DataFrame, *, today: date, seed: str = "42") -> DataFrame:
    """A customer for each ``id``, who signed up in the year before ``today``.

    ``spark.range(1, 301)`` gives the ids of the sample shop.
    """
    key = F.col("id")
    first = _pick(key, f"{seed}first", FIRST_NAMES)
    last = _pick(key, f"{seed}last", LAST_NAMES)
    return ids.select(
        key.alias("customer_id"),
        F.concat_ws(" ", first, last).alias("full_name"),
        F.concat(F.lower(first), F.lit("."), key.cast("string"), F.lit("@example.com")).alias(
            "email"
        ),
        _pick(key, f"{seed}home", CITIES).alias("city"),
        _day_before(today, draw(key, f"{seed}since") % 366).alias("signup_date"),
    )


def make_products(ids: DataFrame, *, seed: str = "42") -> DataFrame:
    """A product for each ``id``, priced from 5.00 to 500.00."""
    key = F.col("id")
    cents = 500 + draw(key, f"{seed}cents") % 49_501
    title = F.concat_ws(
        " ", _pick(key, f"{seed}look", LOOKS), _pick(key, f"{seed}thing", THINGS)
    )
    return ids.select(
        key.alias("product_id"),
        title.alias("title"),
        _pick(key, f"{seed}kind", CATEGORIES).alias("category"),
        (cents.cast("decimal(10,0)") / 100).cast(PRICE).alias("price"),
    )


def make_orders(
    ids: DataFrame,
    *,
    customers: int | Column = 300,
    products: int | Column = 50,
    today: date,
    seed: str = "42",
) -> DataFrame:
    """An order of one product for each ``id``, from the 180 days before ``today``.

    Customer ids are drawn from 1 to ``customers``, product ids from 1 to ``products``.
    """
    key = F.col("id")
    return ids.select(
        key.alias("order_id"),
        (draw(key, f"{seed}buyer") % customers + 1).alias("customer_id"),
        (draw(key, f"{seed}item") % products + 1).alias("product_id"),
        (draw(key, f"{seed}units") % 5 + 1).cast("int").alias("quantity"),
        _day_before(today, draw(key, f"{seed}when") % 181).alias("order_date"),
        _pick(key, f"{seed}state", STATUSES).alias("status"),
    )
