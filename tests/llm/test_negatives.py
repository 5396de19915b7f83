import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_fixtures import table, tuples  # noqa: F401
from tillwork.llm import negatives
from tillwork.llm.negatives import hard_negatives, quantized
from tillwork.llm.residues import moduli_for, product

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, every=100):
    """The definition, row by row, in Python's integers."""
    usable = set()
    for vec_id, vector, label in rows:
        if vec_id is None or label is None or vector is None:
            continue
        if any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = int(math.fmod(label + 1, 10)) if vec_id % 7 == 0 else label
        usable.add((vec_id, label, tuple(math.floor(256 * float(np.float32(x))) for x in vector)))
    out = Counter()
    for anchor in usable:
        if anchor[0] % every:
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(anchor[2], r[2])), r[0], r[1]) for r in usable
        )
        near = [(-s, i) for s, i, label in scored if label == anchor[1] and i != anchor[0]][:5]
        for top, positive in near:
            far = [
                (-s, i)
                for s, i, label in scored
                if label != anchor[1] and 80 * top <= 100 * -s <= 100 * top
            ]
            out.update(
                (anchor[0], positive, rank, i, top, s) for rank, (s, i) in enumerate(far[:5], 1)
            )
    return out


def check(table, rows, every=100):
    got = hard_negatives(table(rows, SCHEMA), F.col("vec_id") % every == 0)
    names = "anchor_id positive_id rank negative_id positive_score negative_score".split()
    assert Counter(tuples(got.select(*names))) == expected(rows, every)


def random_rows(seed, n, dims, labels, grid):
    draw = np.random.default_rng(seed)
    vectors = draw.integers(-grid, grid + 1, (n, dims)) / 16
    hot = draw.random(n) < 0.34
    of = np.where(hot, 1, draw.integers(0, labels, n))
    return [(i, v, int(k)) for i, (v, k) in enumerate(zip(vectors.tolist(), of))]


@pytest.mark.parametrize("grid", [1, 40])
def test_same_as_plain_code(table, monkeypatch, grid):
    """Ties in plenty, a hot label, and many blocks of anchors and rows."""
    monkeypatch.setattr(negatives, "ROWS", 23)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    check(table, random_rows(grid, 300, 5, 6, grid), every=10)


def test_one_block(table):
    check(table, random_rows(3, 250, 70, 4, 30), every=25)


def test_edges(table):
    nan, inf = float("nan"), float("inf")
    rows = random_rows(5, 60, 4, 3, 8)
    rows += [
        (None, [1.0, 1.0, 1.0, 1.0], 1),
        (100, None, 1),
        (200, [1.0, None, 1.0, 1.0], 1),
        (300, [1.0, nan, 1.0, 1.0], 1),
        (400, [1.0, -inf, 1.0, 1.0], 2),
        (500, [1.0, 1.0, 1.0, 1.0], None),
        (600, [], 1),
        (700, [1.0], 2),
        (800, [1.0] * 300, 1),
        (801, [1.0] * 300, 2),
        (802, [-0.0] * 3, 1),
        (-100, [2.0, 2.0, 2.0, 2.0], -3),
        (-101, [2.0, 2.0, 2.0, 2.0], -3),
    ]
    rows += rows[:7]
    rows += [(20, [3.0, 3.0, 3.0, 3.0], 1), (21, [3.0, 3.0, 3.0, 3.0], 2)]
    check(table, rows, every=20)


def test_empty_table_and_lone_anchor(table):
    check(table, [])
    check(table, [(0, [1.0, 2.0], 1)])
    check(table, [(0, [], 1), (1, [], 1), (2, [], 2)])


def test_huge_components_count_as_the_largest(table):
    rows = [(0, [3e38, 1.0], 1), (1, [3e38, 2.0], 1), (2, [3e38, 3.0], 2), (3, [1.0, 3.0], 2)]
    got = tuples(hard_negatives(table(rows, SCHEMA), F.col("vec_id") % 100 == 0))
    assert [r[:4] for r in got] == [(0, 2, 1, 1)]


def test_rows_of_one_id_do_not_multiply(table, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 50)
    rows = random_rows(8, 80, 3, 3, 4)
    check(table, rows + [(100, [0.5, 0.5, 0.5], 1)] * 2_000, every=50)


@pytest.mark.parametrize("most", [1, 256, 2**20, 2**30])
@pytest.mark.parametrize("width", [1, 64, 65, 300])
def test_products_are_exact(most, width):
    if width * most**2 >= 2**63:
        most = math.isqrt((2**63 - 1) // width)
    draw = np.random.default_rng(width)
    a = draw.integers(-most, most + 1, (7, width))
    b = draw.integers(-most, most + 1, (9, width))
    a[0], b[0], b[1] = most, most, -most
    assert product(a, b).tolist() == (a.astype(object) @ b.astype(object).T).tolist()


def test_moduli_keep_all_values_apart():
    for most in (1, 10**6, 2**40, 2**63 - 1):
        found = moduli_for(most)
        assert math.prod(found) > 2 * most and len(set(found)) == len(found)
        assert all(64 * (p // 2) ** 2 < 2**24 for p in found)


def test_quantized():
    assert quantized([[0.5, -0.001], [1.0]], 3).tolist() == [[128, -1, 0], [256, 0, 0]]
