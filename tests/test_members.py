"""Membership by bits and by a join against plain sets."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import tuples
from tillwork.operators import members
from tillwork.operators.members import id_bits, mark_members


def _check(spark, ids, parents, most):
    rows = spark.createDataFrame([(i, n) for n, i in enumerate(ids)], "v bigint, n int")
    known = spark.createDataFrame([(p,) for p in parents], "id bigint")
    got = mark_members(rows, "v", known, "id", "found", most)
    assert sorted(got.columns) == ["found", "n", "v"]
    want = {n: (i, True if i is not None and i in parents else None) for n, i in enumerate(ids)}
    assert {n: (v, found) for v, n, found in tuples(got, "v", "n", "found")} == want


@pytest.mark.parametrize("most", [0, 10**6])
def test_members(spark, most):
    r = random.Random(most)
    parents = {r.randrange(-3_000, 3_000) for _ in range(900)}
    parents |= {2**63 - 1, -(2**63), 2**40, 63, 64, 511, 512, -1, -512, -513}
    ids = [r.randrange(-3_500, 3_500) for _ in range(2_000)] + sorted(parents) + [None, 0]
    _check(spark, ids, parents, most)


@pytest.mark.parametrize("most", [0, 10**6])
def test_no_parents_and_no_rows(spark, most):
    _check(spark, [1, None], set(), most)
    _check(spark, [], {1, 2}, most)


def test_close_ids_take_a_row_for_512(spark):
    ids = spark.range(100_000).unionByName(spark.range(50_000)).withColumn("id", F.col("id") + 512)
    bits = id_bits(ids, "id")
    assert bits.count() == 196
    assert bits.select(F.sum(sum(F.bit_count(f"_w{n}") for n in range(8)))).first()[0] == 100_000


def test_rows_stay_where_they_are(spark, setting):
    """With automatic broadcasts off, the rows are not shuffled for the check."""
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows, parents = spark.range(10_000).withColumnRenamed("id", "v"), spark.range(0, 20_000, 2)
    plan = mark_members(rows, "v", parents, "id", "found")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    joined = mark_members(rows, "v", parents, "id", "found", most=10)
    assert "SortMergeJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.filter("found").count() == 5_000
    assert members.MOST_ROWS * 9 * 8 < 40 * 10**6
