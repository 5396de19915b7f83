"""Every registered query against its SQL counterpart in DuckDB."""

import os

import duckdb
import pytest

from __spark_entry__ import entry
from tillwork.catalogue import QUERIES
from tillwork.oracle import ORACLE

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    yield con
    con.close()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


def test_entry(spark):
    assert entry(spark).columns == ["month", "total_revenue", "order_count", "avg_order_value"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_result(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    cursor = duck.execute(ORACLE[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(df.columns)
    columns = sorted(names)
    ours = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    theirs = sorted(
        (tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()), key=repr
    )
    assert ours == theirs
    assert ours
