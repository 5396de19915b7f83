from datetime import date

from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.model import STATUSES
from tillwork.plans import cleaning, generate

TODAY = date(2025, 6, 30)


def _ids(spark, n):
    return spark.range(1, n + 1)


def test_same_rows_however_partitioned(spark):
    customers = generate.make_customers(_ids(spark, 200), today=TODAY)
    once = sorted(tuples(generate.dirty_customers(customers)), key=repr)
    again = sorted(tuples(generate.dirty_customers(customers.repartition(13))), key=repr)
    assert once == again
    other = sorted(tuples(generate.dirty_customers(customers, seed="7")), key=repr)
    assert once != other


def test_values_stay_in_their_ranges(spark):
    products = generate.make_products(_ids(spark, 300))
    low, high = products.agg(F.min("price"), F.max("price")).first()
    assert 5 <= low and high <= 500
    orders = generate.make_orders(_ids(spark, 400), today=TODAY)
    assert {r[0] for r in tuples(orders.select("status").distinct())} == set(STATUSES)
    first, last = orders.agg(F.min("order_date"), F.max("order_date")).first()
    assert (TODAY - first).days <= 180 and last <= TODAY
    assert tuples(orders.agg(F.min("quantity"), F.max("quantity"))) == [(1, 5)]


def test_faults_come_at_about_their_rates(spark):
    n = 120_000
    customers = generate.make_customers(_ids(spark, n), today=TODAY)
    products = generate.make_products(_ids(spark, n))
    orders = generate.make_orders(_ids(spark, n), customers=n, products=n, today=TODAY)
    good_c, bad_c = cleaning.clean_customers(generate.dirty_customers(customers))
    good_p, bad_p = cleaning.clean_products(generate.dirty_products(products))
    # Against the untouched parents, so that only planted faults count.
    _, bad_o = cleaning.clean_orders(generate.dirty_orders(orders), customers, products)
    counts = cleaning.reason_counts(cleaning.dead_letter(bad_c, bad_p, bad_o))
    found = {(s, r): c / n for s, r, c in tuples(counts)}
    rates = {
        ("customers", "missing full_name"): 0.05,
        ("customers", "missing email"): 0.05,
        ("customers", "invalid email format"): 0.05,
        ("customers", "missing city"): 0.05,
        ("customers", "invalid signup_date"): 0.05,
        ("products", "missing title"): 0.05,
        ("products", "missing category"): 0.05,
        ("products", "invalid price"): 0.04,
        ("products", "price must be positive"): 0.05,
        ("orders", "customer_id not found"): 0.04,
        ("orders", "product_id not found"): 0.04,
        ("orders", "quantity must be positive"): 0.05,
        ("orders", "invalid quantity"): 0.02,
        ("orders", "invalid status"): 0.05,
        ("orders", "invalid order_date"): 0.03,
    }
    for key, rate in rates.items():
        assert abs(found[key] - rate) < 0.01, key
    # Some used emails belonged to a row that was itself rejected or changed.
    assert 0.02 < found["customers", "duplicate email"] <= 0.06
    assert good_c.count() + bad_c.count() == good_p.count() + bad_p.count() == n


def test_used_emails_come_from_ids_with_gaps(spark):
    ids = spark.range(1, 4001).selectExpr("id * 1000003 AS id")
    customers = generate.make_customers(ids, today=TODAY)
    _, bad = cleaning.clean_customers(generate.dirty_customers(customers))
    used = bad.filter(F.contains("rejection_reason", F.lit("duplicate email"))).count()
    assert 0.02 * 4000 < used <= 0.06 * 4000


def test_no_faults_at_rate_zero(spark):
    none = generate.FaultRates(**{f: 0.0 for f in generate.FaultRates.__dataclass_fields__})
    customers = generate.make_customers(_ids(spark, 50), today=TODAY)
    good, bad = cleaning.clean_customers(generate.dirty_customers(customers, none))
    assert (good.count(), bad.count()) == (50, 0)
