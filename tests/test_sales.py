"""Sales questions on a shop small enough to check by hand."""

from datetime import date
from decimal import Decimal as D

import pytest

from tests.conftest import tuples
from tillwork.plans import reports, sales


@pytest.fixture(scope="module")
def shop(spark):
    customers = spark.createDataFrame(
        [
            (1, "Ann", "ann@x.org", "Rome"),
            (2, "Bob", "bob@x.org", "Rome"),
            (3, "Cy", "cy@x.org", "Bonn"),
            (4, "Dee", "dee@x.org", "Bonn"),
        ],
        "customer_id bigint, full_name string, email string, city string",
    )
    products = spark.createDataFrame(
        [(1, "Lamp", "home", D("10.00")), (2, "Soap", "bath", D("2.50")), (3, "Rug", "home", D(99))],
        "product_id bigint, title string, category string, price decimal(10,2)",
    )
    orders = spark.createDataFrame(
        [
            (1, 1, 1, 2, date(2025, 1, 5), "completed"),
            (2, 1, 2, 4, date(2025, 1, 5), "completed"),
            (3, 2, 1, 1, date(2025, 3, 1), "completed"),
            (4, 2, 1, 5, date(2025, 3, 2), "returned"),
            (5, 3, 2, 7, date(2025, 2, 1), "pending"),
            (6, 3, 1, 1, date(2025, 1, 1), "cancelled"),
            (7, 2, 1, 1, date(2025, 3, 3), "pending"),
        ],
        "order_id bigint, customer_id bigint, product_id bigint, quantity int, order_date date, "
        "status string",
    )
    payments = spark.createDataFrame(
        [
            (1, 1, date(2025, 1, 6), D("999.99"), "Card"),
            (2, 1, date(2025, 2, 6), D("1000.00"), "Card"),
            (3, 3, date(2025, 1, 7), D("5000.00"), "Cash"),
            (4, 5, date(2025, 2, 1), D("4999.99"), "Cash"),
            (5, 5, date(2025, 2, 1), D("1.00"), "Card"),
        ],
        "payment_id bigint, order_id bigint, payment_date date, amount decimal(10,2), "
        "method string",
    )
    return customers, products, orders, payments


def test_revenue_by_category(shop):
    _, products, orders, _ = shop
    assert tuples(sales.revenue_by_category(orders, products)) == [
        ("home", 2, D("30.00")),
        ("bath", 1, D("10.00")),
    ]


def test_top_customers_count_pairs_of_order_and_payment(shop):
    customers, _, orders, payments = shop
    expected = [("Bob", "Rome", 1, D("5000.00")), ("Ann", "Rome", 2, D("1999.99"))]
    assert tuples(sales.top_customers_by_payments(customers, orders, payments)) == expected
    top = sales.top_customers_by_payments(customers, orders, payments, n=1)
    assert tuples(top) == expected[:1]


def test_monthly_payments_of_any_status_in_time_order(shop):
    _, _, orders, payments = shop
    assert tuples(sales.monthly_payments(payments, orders)) == [
        ("Jan 2025", 2, D("5999.99")),
        ("Feb 2025", 3, D("6000.99")),
    ]


def test_popular_products_leave_out_returned_orders_only(shop):
    _, products, orders, _ = shop
    assert tuples(sales.popular_products(products, orders)) == [
        ("Soap", "bath", D("2.50"), 11, 2),
        ("Lamp", "home", D("10.00"), 5, 4),
    ]


def test_rank_in_city_covers_all_statuses(shop):
    customers, _, orders, payments = shop
    assert tuples(sales.customer_rank_in_city(customers, orders, payments)) == [
        ("Bonn", "Cy", D("5000.99"), 1),
        ("Rome", "Bob", D("5000.00"), 1),
        ("Rome", "Ann", D("1999.99"), 2),
    ]


def test_payments_in_sequence(shop):
    payments = shop[3]
    assert [r[2] for r in tuples(sales.running_revenue(payments))] == [
        D("999.99"),
        D("5999.99"),
        D("10999.98"),
        D("11000.98"),
        D("12000.98"),
    ]
    assert [(r[0], r[3], r[4]) for r in tuples(sales.payment_vs_previous(payments))][:2] == [
        (1, None, None),
        (3, D("999.99"), D("4000.01")),
    ]
    assert [(r[0], r[3], r[4]) for r in tuples(sales.payment_vs_next(payments))][-2:] == [
        (5, D("1000.00"), D("999.00")),
        (2, None, None),
    ]


def test_order_sequence_breaks_same_day_ties_by_id(shop):
    customers, _, orders, _ = shop
    got = tuples(sales.order_sequence(orders, customers), "full_name", "order_id", "order_number")
    assert got[:2] == [("Ann", 1, 1), ("Ann", 2, 2)]
    assert got[-2:] == [("Cy", 6, 1), ("Cy", 5, 2)]


def test_order_sizes_at_the_edges_of_the_bands(shop):
    customers, products, orders, payments = shop
    got = tuples(sales.order_sizes(orders, customers, products, payments), "amount", "order_size")
    assert got == [
        (D("5000.00"), "Large"),
        (D("4999.99"), "Medium"),
        (D("1000.00"), "Medium"),
        (D("999.99"), "Small"),
        (D("1.00"), "Small"),
    ]


def test_never_completed_includes_those_who_never_ordered(shop):
    customers, _, orders, _ = shop
    assert [r[0] for r in tuples(sales.never_completed(customers, orders))] == ["Cy", "Dee"]


def test_preferred_method_keeps_ties(shop):
    customers, _, orders, payments = shop
    assert tuples(sales.preferred_payment_method(customers, orders, payments)) == [
        ("Bonn", "Card", 1),
        ("Bonn", "Cash", 1),
        ("Rome", "Card", 2),
    ]


def test_return_rate_of_exactly_the_limit_is_normal(shop):
    _, products, orders, _ = shop
    assert tuples(sales.return_rates(products, orders)) == [
        ("Lamp", 5, 1, D("20.00"), "Normal"),
        ("Soap", 2, 0, D("0.00"), "Normal"),
    ]
    flagged = sales.return_rates(products, orders, risk_pct=19)
    assert tuples(flagged, "return_flag")[0] == ("High Return Risk",)


def test_report_sections(shop):
    customers, products, orders, _ = shop
    report = reports.sales_report(customers, products, orders)
    assert tuples(report["revenue_by_category"]) == [("home", D("30.00")), ("bath", D("10.00"))]
    assert tuples(report["top_customers"]) == [
        (1, "Ann", "Rome", D("30.00")),
        (2, "Bob", "Rome", D("10.00")),
    ]
    assert tuples(report["orders_by_status"]) == [
        ("completed", 3),
        ("pending", 2),
        ("cancelled", 1),
        ("returned", 1),
    ]
    # February has no completed order, so March follows January.
    assert tuples(report["mom_revenue"]) == [
        ("2025-01", D("30.00"), None, None, None),
        ("2025-03", D("10.00"), D("30.00"), D("-20.00"), D("-66.67")),
    ]


def test_one_month_has_nothing_before_it(shop):
    _, products, orders, _ = shop
    one = orders.filter("order_date < '2025-02-01'")
    assert tuples(reports.month_over_month(one, products)) == [
        ("2025-01", D("30.00"), None, None, None)
    ]


def test_empty_tables(shop):
    customers, products, orders, payments = (df.filter("false") for df in shop)
    for df in (
        sales.revenue_by_category(orders, products),
        sales.customer_rank_in_city(customers, orders, payments),
        sales.running_revenue(payments),
        sales.order_sequence(orders, customers),
        reports.month_over_month(orders, products),
    ):
        assert tuples(df) == []
