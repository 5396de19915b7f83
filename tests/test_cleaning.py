"""Cleaning rules one by one, their order, and the first-accepted rule for emails."""

import random
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.model import RAW_CUSTOMERS, RAW_ORDERS, RAW_PRODUCTS
from tillwork.plans import cleaning
from tillwork.plans.cleaning import (
    clean_customers,
    clean_orders,
    clean_payments,
    clean_products,
)
from tillwork.sources.feeds import positioned, read_feed, with_file_ids


def _feed(spark, columns, rows):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def _reasons(rejected, key):
    return dict(tuples(rejected, key, "rejection_reason"))


def test_customer_rules_and_their_order(spark):
    rows = [
        ("1", " Ann ", "ann@x.org", "Rome\t", "2024-1-5"),
        ("2", None, "b@x.org", "Rome", None),
        ("3", "C", " ", "Rome", ""),
        ("4", "D", "d.x.org", "Rome", " "),
        ("5", "E", "ANN@X.ORG ", "Rome", "2024-01-01"),
        ("6", "F", "f@x.org", " ", "2024-01-01"),
        ("7", "G", "g@x.org", "Rome", "2024"),
        ("8", "", "d@x", "", "soon"),
        ("x9", "I", "i@x.org", "Rome", None),
    ]
    good, bad = cleaning.clean_customers(_feed(spark, RAW_CUSTOMERS, rows))
    assert tuples(good) == [(1, "Ann", "ann@x.org", "Rome", date(2024, 1, 5))]
    assert _reasons(bad, "customer_id") == {
        "2": "missing full_name",
        "3": "missing email",
        "4": "invalid email format",
        "5": "duplicate email",
        "6": "missing city",
        "7": "invalid signup_date",
        "8": "missing full_name; invalid email format; missing city; invalid signup_date",
        "x9": "invalid customer_id",
    }
    # The dead letter keeps the cells as they came.
    assert tuples(bad.filter("customer_id = '5'")) == [
        ("5", "E", "ANN@X.ORG ", "Rome", "2024-01-01", "customers", "duplicate email")
    ]


def test_product_rules_and_their_order(spark):
    rows = [
        ("1", "Lamp", "home", " 9.99 "),
        ("2", "Lamp", "home", None),
        ("3", "Lamp", "home", "-5"),
        ("4", "Lamp", "home", "0"),
        ("5", "", " ", "abc"),
        ("6", "Lamp", "home", "1e9"),
        ("", "Lamp", "home", "1"),
    ]
    good, bad = cleaning.clean_products(_feed(spark, RAW_PRODUCTS, rows))
    assert tuples(good) == [(1, "Lamp", "home", Decimal("9.99"))]
    assert _reasons(bad, "product_id") == {
        "2": "invalid price",
        "3": "price must be positive",
        "4": "price must be positive",
        "5": "invalid price; missing title; missing category",
        "6": "invalid price",
        "": "invalid product_id",
    }


def test_order_rules_their_order_and_cascading_parents(spark):
    customers = spark.createDataFrame([(1,), (1,)], "customer_id bigint")
    products = spark.createDataFrame([(5,)], "product_id bigint")
    rows = [
        ("1", " 1", "5", "3", "2025-01-02 ", " completed"),
        ("2", "1", "5", "0", "2025-01-02", "pending"),
        ("3", "1", "5", "two", "2025-01-02", "pending"),
        ("4", "1", "5", "1", "2025-01-02", "Completed"),
        ("5", "1", "5", "1", None, "pending"),
        ("6", "9", "8", "1", "2025-01-02", "pending"),
        ("7", "a", None, "-2", "2025-13-40", "shipped"),
        (None, "1", "5", "1", "2025-01-02", "pending"),
    ]
    feed = _feed(spark, RAW_ORDERS, rows)
    good, bad = cleaning.clean_orders(feed, customers, products)
    # The repeated parent does not double its order.
    assert tuples(good) == [(1, 1, 5, 3, date(2025, 1, 2), "completed")]
    assert _reasons(bad, "order_id") == {
        "2": "quantity must be positive",
        "3": "invalid quantity",
        "4": "invalid status",
        "5": "invalid order_date",
        "6": "customer_id not found; product_id not found",
        "7": "quantity must be positive; invalid status; invalid order_date; "
        "invalid customer_id; invalid product_id",
        None: "invalid order_id",
    }
    none = customers.filter("false")
    good, bad = cleaning.clean_orders(feed, none, products)
    assert good.count() == 0 and bad.count() == len(rows)


def test_only_accepted_rows_reserve_their_email(spark):
    """Against the rule told as a loop over the rows."""
    r = random.Random(1)
    rows = []
    for i in range(1, 401):
        email = r.choice(["", "none", f"{r.choice('aA')}{r.randrange(60)}@x.org"])
        rows.append((str(i), r.choice(["", "N", "N", "N"]), email, r.choice(["", "C", "C"]), None))
    taken, accepted = set(), set()
    for i, name, email, city, _ in rows:
        if "@" in email and name and city and email.lower() not in taken:
            taken.add(email.lower())
            accepted.add(int(i))
    feed = _feed(spark, RAW_CUSTOMERS, rows).repartition(6)
    good, bad = cleaning.clean_customers(feed)
    assert {r["customer_id"] for r in good.collect()} == accepted
    assert bad.count() == len(rows) - len(accepted)


def test_one_email_in_most_rows(spark):
    rows = [(str(i), "N", "hot@x.org" if i % 4 else f"u{i}@x.org", "C", None) for i in range(800)]
    good, bad = cleaning.clean_customers(_feed(spark, RAW_CUSTOMERS, rows))
    assert {r[0] for r in tuples(good)} == {1, *range(0, 800, 4)}
    assert bad.count() == 599


def test_csv_feed_uses_file_position(spark, tmp_path):
    """Equal rows and unordered ids: what stands first in the file is accepted."""
    (tmp_path / "f.csv").write_text(
        "customer_id,full_name,email,city,signup_date\n"
        '9,"Doe, ""Jo""",a@x.org,Rome,2024-01-01\n'
        "2,Ann,A@x.org,Rome,NaN\n"
        "9,N/A,c@x.org,Rome,\n"
        '9,"Doe, ""Jo""",a@x.org,Rome,2024-01-01\n'
        "4,Bob,b@x.org,Rome,null\n"
    )
    feed = read_feed(spark, str(tmp_path / "f.csv"), RAW_CUSTOMERS, position=True)
    good, bad = cleaning.clean_customers(feed)
    assert sorted(tuples(good, "customer_id", "full_name", "signup_date")) == [
        (4, "Bob", None),
        (9, 'Doe, "Jo"', date(2024, 1, 1)),
    ]
    rejected = tuples(bad, "customer_id", "full_name", "rejection_reason")
    assert sorted(rejected, key=repr) == [
        ("2", "Ann", "duplicate email"),
        ("9", 'Doe, "Jo"', "duplicate email; duplicate customer_id"),
        ("9", None, "missing full_name; duplicate customer_id"),
    ]
    assert bad.columns == [*RAW_CUSTOMERS, "source_table", "rejection_reason"]


def test_ids_from_file_order_across_splits(spark, setting, tmp_path):
    for part in range(3):
        lines = "".join(f"t{part * 500 + n},c,1.00\n" for n in range(500))
        (tmp_path / f"part-{part}.csv").write_text("title,category,price\n" + lines)
    # Small splits: each file is read by several tasks.
    setting("spark.sql.files.maxPartitionBytes", "2048")
    setting("spark.sql.files.openCostInBytes", "0")
    feed = read_feed(spark, str(tmp_path), ("title", "category", "price"), position=True)
    assert feed.rdd.getNumPartitions() > 3
    got = with_file_ids(feed, "product_id")
    assert got.columns == ["product_id", "title", "category", "price"]
    assert dict(tuples(got, "title", "product_id")) == {f"t{n}": n + 1 for n in range(1500)}


def test_dead_letter_columns_counts_and_invariant(spark):
    customers = _feed(spark, RAW_CUSTOMERS, [("1", "", "", "C", None), ("2", "N", "n@x.y", "C", "")])
    products = _feed(spark, RAW_PRODUCTS, [("1", "", "c", "1")])
    _, bad_customers = cleaning.clean_customers(customers)
    _, bad_products = cleaning.clean_products(products)
    dead = cleaning.dead_letter(bad_customers, bad_products)
    assert dead.columns == [*RAW_CUSTOMERS, "source_table", "rejection_reason"] + [
        "product_id",
        "title",
        "category",
        "price",
    ]
    assert sorted(tuples(cleaning.reason_counts(dead))) == [
        ("customers", "missing email", 1),
        ("customers", "missing full_name", 1),
        ("products", "missing title", 1),
    ]
    counts = cleaning.load_counts(
        {
            "customers": cleaning.annotate_customers(customers),
            "products": cleaning.annotate_products(products),
        }
    )
    assert dict(tuples(counts)) == {"customers": 1, "products": 0, "rejected": 2}
    assert dead.filter(F.col("rejection_reason") == "").count() == 0


def test_repeated_ids_and_long_texts_are_rejected(spark):
    rows = [
        ("1", "", "a@x.org", "Rome", None),
        ("1", "Ann", "a@x.org", "Rome", None),
        ("1", "Ann", "a@x.org", "Rome", None),
        ("1", "Eve", "c@x.org", "Rome", None),
        ("2", "Cat", "c@x.org", "Rome", None),
        ("3", "N" * 101, "n@x.org", "R" * 51, None),
        ("4", "N" * 100, "e" * 90 + "@x.org.com.net", "Rome", None),
    ]
    good, bad = cleaning.clean_customers(_feed(spark, RAW_CUSTOMERS, rows))
    assert sorted(tuples(good, "customer_id", "full_name")) == [(1, "Ann"), (2, "Cat")]
    assert sorted(tuples(bad, "customer_id", "full_name", "rejection_reason")) == [
        ("1", "", "missing full_name"),
        ("1", "Ann", "duplicate email; duplicate customer_id"),
        ("1", "Eve", "duplicate customer_id"),
        ("3", "N" * 101, "full_name too long; city too long"),
        ("4", "N" * 100, "email too long"),
    ]
    products = [
        ("1", "Lamp", "home", "0.004"),
        ("1", "Lamp", "home", "0.005"),
        ("1", "Cup", "home", "2"),
        ("2", "T" * 151, "c" * 51, "19.999"),
        ("3", "Cup", "home", "19.999"),
    ]
    good, bad = cleaning.clean_products(_feed(spark, RAW_PRODUCTS, products))
    assert sorted(tuples(good, "product_id", "price")) == [
        (1, Decimal("0.01")),
        (3, Decimal("20.00")),
    ]
    assert sorted(tuples(bad, "title", "rejection_reason")) == [
        ("Cup", "duplicate product_id"),
        ("Lamp", "price must be positive"),
        ("T" * 151, "title too long; category too long"),
    ]
    orders = [
        ("7", "1", "1", "0", "2025-01-02", "pending"),
        ("7", "1", "1", "2", "2025-01-02", "pending"),
        ("7", "1", "1", "3", "2025-01-02", "pending"),
    ]
    parents = spark.createDataFrame([(1, 1)], "customer_id bigint, product_id bigint")
    good, bad = cleaning.clean_orders(_feed(spark, RAW_ORDERS, orders), parents, parents)
    assert tuples(good, "quantity") == [(2,)]
    assert _reasons(bad, "quantity") == {
        "0": "quantity must be positive",
        "3": "duplicate order_id",
    }


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_equal_rows_without_a_place_of_their_own(spark, setting, partitions):
    """Out of a shuffle, rows stand elsewhere each time; still exactly one of equal ones stays."""
    setting("spark.sql.adaptive.enabled", "false")
    setting("spark.sql.shuffle.partitions", str(partitions))
    n = 400

    def shuffled(rows):
        # rand() without a seed deals the rows anew at every evaluation.
        return rows.repartition(partitions, F.expr("rand()"))

    twice = spark.range(n).selectExpr("id DIV 2 AS i")
    customers = shuffled(
        twice.selectExpr("string(i) AS customer_id", "'A' AS full_name", "concat('c', i, '@x.org') AS email", "'T' AS city", "'' AS signup_date")
    )
    products = shuffled(
        twice.selectExpr("string(i) AS product_id", "'P' AS title", "'C' AS category", "'1.00' AS price")
    )
    good_customers, bad_customers = clean_customers(customers)
    good_products, bad_products = clean_products(products)
    orders = shuffled(
        twice.selectExpr("string(i) AS order_id", "string(i) AS customer_id", "string(i) AS product_id", "'1' AS quantity", "'2025-01-01' AS order_date", "'pending' AS status")
    )
    good_orders, bad_orders = clean_orders(orders, good_customers, good_products)
    payments = shuffled(
        twice.selectExpr("string(i) AS payment_id", "string(i) AS order_id", "'2025-01-01' AS payment_date", "'1.00' AS amount", "'card' AS method")
    )
    good_payments, bad_payments = clean_payments(payments, good_orders)
    for good, bad, key in (
        (good_customers, bad_customers, "customer_id"),
        (good_products, bad_products, "product_id"),
        (good_orders, bad_orders, "order_id"),
        (good_payments, bad_payments, "payment_id"),
    ):
        assert sorted(r[0] for r in tuples(good.select(key))) == list(range(n // 2))
        assert sorted(int(r[0]) for r in tuples(bad.select(key))) == list(range(n // 2))
        assert all(f"duplicate {key}" in r[0] for r in tuples(bad.select("rejection_reason")))


def test_a_written_position_is_kept_and_given_once(spark, tmp_path):
    df = spark.range(10).repartition(3)
    placed = positioned(df, str(tmp_path))
    assert positioned(placed) is placed
    assert sorted(tuples(placed)) == sorted(tuples(placed))
    assert len({r[1] for r in tuples(placed)}) == 10
    assert len(list(tmp_path.iterdir())) == 1


def test_unique_ids_are_hashed_and_leave_the_feed_in_place(spark, monkeypatch):
    """No sort of all rows to find repeated ids, and no join with none."""
    plans, settled = [], cleaning._settled

    def seen(few):
        plans.append(few._jdf.queryExecution().executedPlan().toString())
        return settled(few)

    monkeypatch.setattr(cleaning, "_settled", seen)
    rows = [(str(i), "T", "c", "1.00") for i in range(20)]
    annotated = cleaning.annotate_products(_feed(spark, RAW_PRODUCTS, rows))
    assert len(plans) == 1 and "SortAggregate" not in plans[0]
    assert "Join" not in annotated._jdf.queryExecution().optimizedPlan().toString()
    assert annotated.filter("reasons = ''").count() == 20


@pytest.mark.parametrize("few", [0, 10_000])
def test_first_good_row_of_an_id_in_a_feed_without_places(spark, monkeypatch, few):
    monkeypatch.setattr(cleaning, "_FEW", few)
    rows = [
        ("7", "", "c", "1.00"), ("7", "A", "c", "2.00"), ("07", "B", "c", "3.00"),
        ("8", "", "c", "1.00"), ("8", "", "c", "2.00"), ("9", "C", "c", "4.00"),
        ("x", "D", "c", "5.00"), ("x", "E", "c", "5.00"),
    ]
    feed = _feed(spark, RAW_PRODUCTS, rows).coalesce(1)
    good, bad = clean_products(feed)
    assert sorted(tuples(good.select("product_id", "title"))) == [(7, "A"), (9, "C")]
    assert sorted(tuples(bad.select("product_id", "price", "rejection_reason"))) == [
        ("07", "3.00", "duplicate product_id"),
        ("7", "1.00", "missing title"),
        ("8", "1.00", "missing title"),
        ("8", "2.00", "missing title"),
        ("x", "5.00", "invalid product_id"),
        ("x", "5.00", "invalid product_id"),
    ]
