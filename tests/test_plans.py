"""The plans of the registered queries, as they would be for tables of any size."""

import re

import pytest

from tillwork.catalogue import QUERIES
from tillwork.plans import publish

FOLDER = "/root/testdata/sf0.001"
# These write tables before they return a frame over what was stored.
WRITING = {
    name
    for name in QUERIES
    if name.startswith(("src_", "sink_", "daily_sales_"))
    or name.endswith("_load")
    or name in ("n03_load_verification", "star_refused_loads", "views_stored", "v05_daily_sales_of_a_quarter")
}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _operator(line):
    return re.sub(r"^[\s:+*()\d-]*", "", line)


@pytest.fixture(autouse=True)
def full_size(setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_plan(spark, name):
    lines = _plan(QUERIES[name](spark, FOLDER)).splitlines()
    text = "\n".join(lines)
    # No pairs of everything with everything, and no rows through Python.
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
        assert operator not in text
    # One task receives only what an aggregation, or a limit, has reduced.
    for n, line in enumerate(lines):
        if "SinglePartition" in line:
            below = _operator(lines[n + 1])
            while below.startswith(("Project", "Filter", "Sort")):
                n += 1
                below = _operator(lines[n + 1])
            assert below.startswith(("HashAggregate", "LocalLimit")), below
    # Broadcasts asked for despite the setting: hot keys, their names, calendar days, and the
    # bits of ids, which were counted before.
    for n, line in enumerate(lines):
        if "BroadcastExchange" in line:
            inside = []
            depth = line.index("BroadcastExchange")
            for other in lines[n + 1 :]:
                if re.search(r"[A-Z]", other).start() <= depth:
                    break
                inside.append(other)
            inside = "\n".join(inside)
            assert any(x in inside for x in ("explode(sequence(", "_rows", "_w0"))


def test_a_rank_of_one_is_cut_before_the_shuffle(spark):
    plan = _plan(QUERIES["q12_preferred_payment_method"](spark, FOLDER))
    assert plan.index("WindowGroupLimit") < plan.rindex("WindowGroupLimit")


def test_top_lists_are_taken_without_a_full_sort(spark):
    for name in ("q02_top_customers_by_payments", "q04_popular_products", "r02_top_customers"):
        plan = _plan(QUERIES[name](spark, FOLDER))
        assert "TakeOrderedAndProject" in plan
        assert "rangepartitioning" not in plan


@pytest.mark.parametrize("name", ["views_stored", "daily_sales_changed_months"])
def test_loads_read_orders_that_were_numbered_before(spark, monkeypatch, name):
    class Seen(Exception):
        pass

    def load(spark, root, customers, products, orders):
        raise Seen(_plan(orders))

    monkeypatch.setattr(publish, "load_star", load)
    with pytest.raises(Seen) as seen:
        QUERIES[name](spark, FOLDER)
    assert "Window" not in str(seen.value) and "Join" not in str(seen.value)
