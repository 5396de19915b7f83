from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.plans import constraints as k


@pytest.fixture(scope="module")
def orders(spark):
    rows = [
        (1, 10, 5, "completed"),
        (1, 11, 0, "lost"),
        (2, 12, None, None),
        (None, 10, -1, "pending"),
        (None, 10, 1, "pending"),
    ]
    return spark.createDataFrame(rows, "order_id int, customer_id int, quantity int, status string")


def test_nulls(orders):
    assert dict(
        tuples(k.null_violations(orders, "o", ["order_id", "quantity"]), "subject", "violations")
    ) == {"order_id": 2, "quantity": 1}


def test_nulls_pass_checks(orders):
    checks = {"positive": F.col("quantity") > 0, "known": F.col("status").isin("completed", "pending")}
    assert tuples(k.check_violations(orders, "o", checks)) == [
        ("o", "check", "positive", 2),
        ("o", "check", "known", 1),
    ]


def test_unique_ignores_nulls(orders):
    got = k.unique_violations(orders, "o", [["order_id"], ["order_id", "customer_id"]])
    assert sorted(tuples(got)) == [
        ("o", "unique", "order_id", 1),
        ("o", "unique", "order_id, customer_id", 0),
    ]
    assert sorted(tuples(k.unique_violation_rows(orders, ["order_id"]), "customer_id")) == [
        (10,),
        (11,),
    ]


def test_foreign_keys_count_rows(spark, orders):
    parents = spark.createDataFrame([(11,), (12,)], "id int")
    got = k.foreign_key_violations(orders, "o", "customer_id", parents, "id")
    assert tuples(got) == [("o", "foreign key", "customer_id", 3)]
    rows = k.foreign_key_violation_rows(orders, "customer_id", parents, "id")
    assert rows.count() == 3


def test_widths(spark):
    df = spark.createDataFrame(
        [("abc", D("12.345")), ("abcd", D("1234.0")), (None, None)], "s string, n decimal(10,3)"
    )
    got = k.width_violations(df, "t", {"s": 3}, {"n": (5, 2)})
    assert dict(tuples(got, "subject", "violations")) == {"s": 1, "n": 1}


def test_enforce(orders):
    k.enforce(k.null_violations(orders, "o", ["customer_id"]))
    with pytest.raises(k.ConstraintError, match=r"o: not null \(order_id\): 2"):
        k.enforce(k.null_violations(orders, "o", ["order_id", "customer_id"]))


def test_several_keys_take_one_pass(orders):
    keys = [["order_id"], ["customer_id"], ["order_id", "customer_id"], ["quantity"]]
    got = k.unique_violations(orders, "o", keys)
    assert dict(tuples(got, "subject", "violations")) == {
        "order_id": 1,
        "customer_id": 1,
        "order_id, customer_id": 0,
        "quantity": 0,
    }
    for key in keys:
        assert tuples(k.unique_violations(orders, "o", [key])) == tuples(
            got.filter(F.col("subject") == ", ".join(key))
        )
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1


def test_samples_name_rows_of_every_broken_rule(orders):
    rules = k.not_null(["order_id", "quantity"]) + k.checks({"positive": F.col("quantity") > 0})
    got = k.rule_samples(orders, "o", rules, "customer_id")
    assert tuples(got) == [
        ("o", "not null", "order_id", 2, 10, 10),
        ("o", "not null", "quantity", 1, 12, 12),
        ("o", "check", "positive", 2, 10, 11),
    ]
    seen = orders.agg(*[c.alias(n) for n, c in k.measures(orders, rules).items()]).first().asDict()
    lines = k.broken_rules("o", rules, seen)
    assert seen["rows"] == 5 and len(lines) == 3
    assert lines[2].startswith("o: check (positive): 2 such as order_id=None, customer_id=10")
    assert "; order_id=1, customer_id=11, quantity=0, status=lost" in lines[2]
