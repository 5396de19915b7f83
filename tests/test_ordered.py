"""The distributed ordered operators against plain loops, with one day or key far too big."""

import random
from collections import defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.model import MONEY_SUM
from tillwork.operators.hot import hot_keys
from tillwork.operators.ordered import (
    cut,
    id_block,
    id_levels,
    next_value,
    previous_value,
    rank_by_amount,
    row_numbers,
    row_numbers_split,
    running_sum,
    spread_blocks,
)
from tillwork.plans import sales

DAY = date(2025, 1, 1)


def _payments(seed: int, n: int = 400):
    """Half of the payments on one day; ids neither sorted nor dense, some below zero."""
    r = random.Random(seed)
    ids = r.sample(range(-500, 5_000), n)
    days = [DAY + timedelta(days=r.choice([3, 3, 3, r.randrange(30)])) for _ in ids]
    return [(i, d, Decimal(r.randrange(1, 10**6)) / 100) for i, d in zip(ids, days)]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id bigint, day date, amount decimal(10,2)").repartition(5)


def _levels(bits):
    return [F.col("day"), id_block("id", bits)]


@pytest.mark.parametrize("bits", [0, 4, 7, 20])
def test_running_sum_and_neighbours(spark, bits):
    rows = _payments(bits)
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    df = _frame(spark, rows)
    total, running = Decimal(0), {}
    for i, _, amount in ordered:
        total += amount
        running[i] = total
    got = running_sum(
        df, "x", F.col("amount"), MONEY_SUM, order_by=["id"], levels=_levels(bits)
    )
    assert dict(tuples(got, "id", "x")) == running
    before = {b[0]: a[2] for a, b in zip(ordered, ordered[1:])} | {ordered[0][0]: None}
    got = previous_value(df, "x", "amount", key="id", levels=_levels(bits))
    assert dict(tuples(got, "id", "x")) == before
    after = {a[0]: b[2] for a, b in zip(ordered, ordered[1:])} | {ordered[-1][0]: None}
    got = next_value(df, "x", "amount", key="id", levels=_levels(bits))
    assert dict(tuples(got, "id", "x")) == after
    numbers = {r[0]: n for n, r in enumerate(ordered, 1)}
    got = row_numbers(df, "x", order_by=["id"], levels=_levels(bits))
    assert dict(tuples(got, "id", "x")) == numbers


def test_null_values_are_neighbours_too(spark):
    rows = [(1, DAY, Decimal(5)), (2, DAY, None), (3, DAY + timedelta(days=1), Decimal(7))]
    df = _frame(spark, rows)
    got = previous_value(df, "x", "amount", key="id", levels=_levels(0))
    assert dict(tuples(got, "id", "x")) == {1: None, 2: Decimal(5), 3: None}
    got = next_value(df, "x", "amount", key="id", levels=_levels(0))
    assert dict(tuples(got, "id", "x")) == {1: None, 2: Decimal(7), 3: None}


def test_empty_input(spark):
    df = _frame(spark, [])
    assert tuples(row_numbers(df, "x", order_by=["id"], levels=_levels(4))) == []


def test_id_levels_cover_wide_ids(spark):
    ids = [-(2**62), -5, 0, 2**14, 2**28 + 1, 2**45, 2**62]
    df = spark.createDataFrame([(i,) for i in ids], "id bigint")
    got = row_numbers(df, "n", order_by=["id"], levels=id_levels(df, "id"))
    assert dict(tuples(got)) == {i: n for n, i in enumerate(ids, 1)}


@pytest.mark.parametrize("partitions", ["1", "4", "64"])
def test_results_do_not_depend_on_partitions(spark, setting, partitions):
    setting("spark.sql.shuffle.partitions", partitions)
    rows = _payments(11)
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    got = row_numbers(_frame(spark, rows), "x", order_by=["id"], levels=_levels(5))
    assert dict(tuples(got, "id", "x")) == {r[0]: n for n, r in enumerate(ordered, 1)}


def test_running_revenue_never_sorts_raw_rows_in_one_partition(spark):
    payments = spark.range(10).select(
        F.col("id").alias("payment_id"),
        F.date_add(F.lit(DAY), (F.col("id") % 3).cast("int")).alias("payment_date"),
        F.col("id").cast("decimal(10,2)").alias("amount"),
    )
    plan = sales.running_revenue(payments, ordered=False)._jdf.queryExecution().toString()
    physical = plan.split("== Physical Plan ==")[1]
    # Every single-partition exchange sits on a sum per day.
    lines = physical.splitlines()
    for n, line in enumerate(lines):
        if "SinglePartition" in line:
            assert "HashAggregate(keys=[_l0" in lines[n + 1]
    assert "hashpartitioning(_l0" in physical


def test_hot_keys_are_few(spark):
    df = spark.createDataFrame([(0,)] * 60 + [(k,) for k in range(1, 41)], "k int")
    assert tuples(hot_keys(df, ["k"], min_rows=10)) == [(0,)]
    assert tuples(hot_keys(df, ["k"], min_rows=60)) == []
    # However low the floor, fewer than max_keys keys qualify.
    assert hot_keys(df, ["k"], min_rows=0).count() == 41


@pytest.mark.parametrize("min_rows", [20, 10**6])
def test_order_sequence_with_a_hot_customer(spark, min_rows):
    r = random.Random(5)
    orders = [
        (i, r.choice([1, 1, 1, r.randrange(2, 40)]), DAY + timedelta(days=r.randrange(9)), "pending")
        for i in r.sample(range(10**7), 300)
    ]
    df = spark.createDataFrame(
        orders, "order_id bigint, customer_id bigint, order_date date, status string"
    )
    people = spark.range(1, 40).select(
        F.col("id").alias("customer_id"), F.concat(F.lit("n"), "id").alias("full_name")
    )
    seen, expected = defaultdict(int), {}
    for i, c, d, _ in sorted(orders, key=lambda o: (o[2], o[0])):
        seen[c] += 1
        expected[i] = (f"n{c}", seen[c])
    got = sales.order_sequence(df, people, min_hot_rows=min_rows)
    rows = tuples(got, "order_id", "full_name", "order_number")
    assert {i: (name, n) for i, name, n in rows} == expected
    assert len(rows) == len(orders)
    assert [(name, n) for _, name, n in rows] == sorted((name, n) for _, name, n in rows)


@pytest.mark.parametrize("min_rows", [20, 10**6])
def test_numbers_with_a_hot_block(spark, min_rows):
    r = random.Random(9)
    rows = list({(r.choice([17, 17, r.randrange(400)]), r.randrange(50)) for _ in range(500)})
    df = spark.createDataFrame(rows, "k bigint, part bigint").repartition(7)
    got = row_numbers_split(
        df,
        "n",
        key="k",
        order_by=["k", "part"],
        finer=F.struct("k", F.shiftright("part", 2).alias("p")),
        min_rows=min_rows,
    )
    assert got.columns == ["k", "part", "n"]
    expected = {row: n for n, row in enumerate(sorted(rows), 1)}
    assert {(k, p): n for k, p, n in tuples(got)} == expected


def test_rank_with_ties_and_a_hot_amount(spark):
    r = random.Random(3)
    rows = [
        (i, r.choice("aab"), Decimal(r.choice([500, 500, r.randrange(1, 9_999_999)])) / 100)
        for i in range(300)
    ]
    df = spark.createDataFrame(rows, "id int, city string, total decimal(28,2)")
    got = rank_by_amount(df, "rank", partition_by=["city"], amount="total", width=7)
    expected = {
        i: 1 + sum(1 for _, c, t in rows if c == city and t > total) for i, city, total in rows
    }
    assert dict(tuples(got, "id", "rank")) == expected


def test_rank_keeps_rows_of_a_null_city(spark):
    rows = [(i, c, Decimal(t)) for i, c, t in ((1, None, 5), (2, "R", 7), (3, None, 9), (4, "R", 7))]
    df = spark.createDataFrame(rows, "id long, city string, total decimal(10,2)")
    got = rank_by_amount(df, "rank", partition_by=["city"], amount="total")
    assert dict(tuples(got, "id", "rank")) == {1: 2, 2: 1, 3: 1, 4: 1}


def test_no_block_is_many_times_its_share_with_an_outlier(spark):
    """2,000,000 dense ids, and one at 2^62."""
    df = spark.range(2_000_000).union(spark.createDataFrame([(2**62,)], "id long"))
    coarse, fine = id_levels(df, "id")
    sizes = [r["count"] for r in df.groupBy(fine.alias("b")).count().collect()]
    assert len(sizes) >= 40 and max(sizes) <= 2 * 2_000_001 / 64
    assert df.select(coarse.alias("a")).distinct().count() <= 20
    below_a_day = df.groupBy(spread_blocks(df, "id").alias("b")).count()
    assert below_a_day.agg(F.max("count")).first()[0] <= 2**20


CROWDED = {
    # Half of all ids between two that are 2^40 apart, and those again in a range of 2^62.
    "nested": "CASE WHEN id = 0 THEN -(1L << 62) WHEN id = 1 THEN 1L << 62 WHEN id = 2 THEN 1L << 40 ELSE id END",
    "powers": "CAST(pow(2, id % 60) AS BIGINT) + id DIV 60",
    "clusters": "(id % 97) * 1000000007 * 1000003 + id DIV 97",
    "one side": "CASE WHEN id = 0 THEN -9223372036854775808 ELSE 9223372036854775807 - id END",
    "repeated": "CASE WHEN id < 800000 THEN 77 ELSE id END",
}


@pytest.mark.parametrize("name", CROWDED)
def test_blocks_of_crowded_ids(spark, name):
    n = 1_200_000
    df = spark.range(n).selectExpr(f"{CROWDED[name]} AS k", "id").cache()
    blocks = cut(df, "k", lambda rows: 64)
    share = -(-n // 64)
    most = df.groupBy("k").count().agg(F.max("count")).first()[0]
    found = df.select("k", blocks.block.alias("b"))
    sizes = found.groupBy("b").agg(
        F.count("b").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")
    )
    rows = sorted(tuples(sizes, "b", "n", "low", "high"))
    assert rows[0][0] >= 0 and rows[-1][0] < blocks.blocks <= 200
    assert max(r[1] for r in rows) == blocks.largest <= max(2 * share, most + share)
    # Blocks are in order of the ids.
    assert all(a[3] < b[2] for a, b in zip(rows, rows[1:]))
    numbers = row_numbers_split(
        df, "n", key="k", order_by=["k", "id"], finer=F.shiftright("id", 16), min_rows=100_000
    )
    wrong = numbers.selectExpr("n", "row_number() OVER (ORDER BY k, id) AS want").filter("n <> want")
    assert wrong.isEmpty() and numbers.count() == n
    df.unpersist()


@pytest.mark.parametrize("ids", ["id", "xxhash64(id)", "id * 100000007", "id + 9000000000000000000"])
def test_blocks_follow_rows_whatever_the_ids(spark, ids):
    """No block holds many times its share, and there are far fewer blocks than rows."""
    n = 200_000
    df = spark.range(n).selectExpr(f"{ids} AS id")
    coarse, fine = id_levels(df, "id")
    blocks = df.groupBy(coarse.alias("a"), fine.alias("b")).count()
    size, groups, outer = blocks.agg(F.max("count"), F.count("b"), F.count_distinct("a")).first()
    assert 16 <= groups <= n / 500
    assert size <= 4 * n / groups
    assert outer <= 2 * groups**0.5 + 1
    numbers = row_numbers(df, "n", order_by=["id"], levels=[coarse, fine])
    found = numbers.selectExpr("id", "n", "row_number() OVER (ORDER BY id) AS want")
    assert found.filter("n <> want").isEmpty() and found.count() == n
