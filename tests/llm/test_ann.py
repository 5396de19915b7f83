import math
from collections import defaultdict

import numpy as np
import pytest
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401
from pyspark.sql import functions as F

from tillwork.llm import ann, router
from tillwork.llm.ann import nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def is_usable(i, v, length):
    return (
        i is not None
        and v is not None
        and len(v) == length
        and all(x is not None and math.isfinite(x) for x in v)
        and any(v)
    )


def brute(rows, length, k, query):
    at = defaultdict(list)
    for i, v in rows:
        if is_usable(i, v, length):
            at[i].append(np.array(v, np.float32).astype(float))
    out = {}
    for i in filter(query, at):
        found = [
            (min(float(np.sqrt(((a - b) ** 2).sum())) for a in at[i] for b in vs), j)
            for j, vs in at.items()
            if j != i
        ]
        out[i] = sorted(found)[:k]
    return out


def found(df):
    out = defaultdict(list)
    for q, rank, i, score in sorted(tuples(df)):
        assert rank == len(out[q]) + 1
        out[q].append((score, i))
    return out


def clusters(draw, n, dim=16, of=12):
    centres = draw.normal(size=(of, dim))
    return (centres[draw.integers(0, of, n)] + 0.15 * draw.normal(size=(n, dim))).tolist()


@pytest.mark.parametrize("parts", [1, 2])
def test_ties_copies_and_unusable_rows(table, monkeypatch, parts):
    monkeypatch.setattr(ann, "_parts", lambda n: parts)
    monkeypatch.setattr(ann, "RECALL", 1.0)
    draw = np.random.default_rng(1)
    rows = [(i, v) for i, v in enumerate(draw.integers(-2, 3, (300, 3)).astype(float).tolist())]
    rows += [rows[7], rows[10], (None, [1.0, 2.0, 3.0]), (900, None), (910, [0.0] * 3)]
    rows += [(920, [1.0, None, 2.0]), (930, [1.0, float("nan"), 2.0]), (940, [float("inf"), 0.0, 1.0])]
    rows += [(950, [1.0, 2.0]), (960, []), (5000, [1e30, 0.0, 0.0])]
    df = table([(i, v, 0) for i, v in rows], SCHEMA)
    got = found(nearest(df, F.col("vec_id") % 10 == 0))
    want = brute(rows, 3, 10, lambda i: i % 10 == 0)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-15)


@pytest.mark.parametrize("block", [50, 16_384])
def test_recall(table, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERIES", block)
    monkeypatch.setattr(ann, "_parts", lambda n: 16)
    draw = np.random.default_rng(2)
    rows = list(enumerate(clusters(draw, 3000)))
    rows += [(3000 + i, rows[50][1]) for i in range(400)]
    got = found(nearest(table([(i, v, 0) for i, v in rows], SCHEMA), F.col("vec_id") % 50 == 0))
    want = brute(rows, 16, 10, lambda i: i % 50 == 0)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert [i for _, i in got[50]] == [i for _, i in want[50]]


def test_routing_leaves_parts_out():
    draw = np.random.default_rng(3)
    vectors = np.array(clusters(draw, 2000))
    learned, far = router.fit(vectors, 16, 0.95)
    asked = router.ahead(learned.odds(np.array(clusters(np.random.default_rng(3), 2000)))) < far
    assert asked.sum(axis=1).mean() < 8


def test_parts_are_balanced():
    vectors = np.random.default_rng(4).normal(size=(1000, 8))
    graph = router.neighbours(vectors, 10)
    part = router.partition(vectors, graph, 8)
    assert np.bincount(part).tolist() == [125] * 8
    cut = (part[graph] != part[:, None]).mean()
    assert cut < (np.random.default_rng(0).permutation(part)[graph] != part[:, None]).mean() - 0.2


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0])], [(100, [0.0, 0.0])], [(1, [1.0]), (100, None)]])
def test_few_rows(table, rows):
    df = table([(i, v, 0) for i, v in rows], SCHEMA)
    assert tuples(nearest(df, F.col("vec_id") % 100 == 0)) == []


def test_fewer_than_k(table):
    df = table([(100, [1.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [1.0, 1.0], 0)], SCHEMA)
    got = tuples(nearest(df, F.col("vec_id") % 100 == 0))
    assert sorted(got) == [(100, 1, 2, 1.0), (100, 2, 1, math.sqrt(2))]


def test_test_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = found(nearest(rows, F.col("vec_id") % 100 == 0))
    want = brute([tuple(r) for r in rows.select("vec_id", "embedding").collect()], 64, 10, lambda i: i % 100 == 0)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


@pytest.mark.parametrize(("parts", "block"), [(1, 16_384), (1, 40), (4, 40)])
def test_repeated_near_ids_leave_room(table, monkeypatch, parts, block):
    """Ids that are there more than k times, as copies or with other vectors, without ties."""
    monkeypatch.setattr(ann, "_parts", lambda n: parts)
    monkeypatch.setattr(ann, "RECALL", 1.0)
    monkeypatch.setattr(ann, "BLOCK", block)
    monkeypatch.setattr(ann, "QUERIES", block)
    draw = np.random.default_rng(5)
    rows = list(enumerate(draw.normal(size=(200, 4)).tolist()))
    for q in (0, 50):
        base = np.array(rows[q][1])
        rows += [(1000 + q, (base + 0.001).tolist())] * 25
        rows += [(2000 + q + 1, (base + 0.002 + 1e-5 * draw.normal(size=4)).tolist()) for _ in range(25)]
    rows += [(100, (np.array(rows[100][1]) + 0.01 * n).tolist()) for n in range(60)]
    df = table([(i, v, 0) for i, v in rows], SCHEMA)
    query = [0, 50, 100, 1000]
    got = found(nearest(df, F.col("vec_id").isin(query)))
    want = brute(rows, 4, 10, lambda i: i in query)
    for q in query:
        assert len(got[q]) == 10
        if parts == 1:
            assert [i for _, i in got[q]] == [i for _, i in want[q]]


def test_copies_of_an_id_are_spread(table, monkeypatch):
    """One id with most rows is not one block."""
    monkeypatch.setattr(ann, "_parts", lambda n: 1)
    monkeypatch.setattr(ann, "BLOCK", 50)
    sizes = table([], "rows int, queries int").sparkSession.sparkContext.accumulator(0)
    plain = ann._nearest

    def watched(k):
        search = plain(k)

        def run(rows, queries):
            sizes.add(len(rows) > 150)
            return search(rows, queries)

        return run

    monkeypatch.setattr(ann, "_nearest", watched)
    draw = np.random.default_rng(6)
    rows = [(7, v) for v in draw.normal(size=(600, 3)).tolist()]
    rows += [(100 + n, v) for n, v in enumerate(draw.normal(size=(20, 3)).tolist())]
    got = found(nearest(table([(i, v, 0) for i, v in rows], SCHEMA), F.col("vec_id") == 100))
    want = brute(rows, 3, 10, lambda i: i == 100)
    assert [i for _, i in got[100]] == [i for _, i in want[100]]
    assert sizes.value == 0
