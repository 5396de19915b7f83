"""Fixtures and rows for the tests of this folder."""

from __future__ import annotations

import random

import pytest

# Names that the operators use inside, as further columns of their input.
CLASHES = [
    "row", "spans", "class", "bucket", "node", "component", "marks", "starts", "half", "held_out",
    "score", "terms", "size", "draw", "of", "its", "below", "whole", "again", "gone", "kept",
    "n_words", "tokens", "hit", "host", "vector", "part", "key", "by", "word", "n",
]


@pytest.fixture
def table(spark):
    """A table of the given rows, with columns that clash; ``schema`` as in DDL."""

    def make(rows, schema):
        extra = ", ".join(f"{c} string" for c in CLASHES if f"{c} " not in schema)
        n = extra.count(",") + 1
        return spark.createDataFrame([tuple(r) + ("x",) * n for r in rows], f"{schema}, {extra}")

    return make


@pytest.fixture
def documents(table):
    """Documents from ``(doc_id, text)`` or ``(doc_id, text, source)``."""

    def make(rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1]))
            for r in rows
        ]
        return table(full, "doc_id long, text string, lang string, source string, n_chars long")

    return make


@pytest.fixture
def prose():
    """Random texts over a small vocabulary."""
    draw = random.Random(7)
    vocabulary = ["".join(draw.choices("abcdefghé", k=draw.randint(1, 9))) for _ in range(400)]

    def make(n):
        return " ".join(draw.choices(vocabulary, k=n))

    make.draw = draw
    return make


def tuples(df):
    return [tuple(r) for r in df.collect()]


def edges(prose):
    """Rows without id or text, blank, very long, repeated, of one id with two texts."""
    long = prose(30_000)
    return [
        (None, prose(120)),
        (None, None),
        (1, None),
        (2, ""),
        (3, " \t\n "),
        (4, long),
        (5, "one two"),
        (5, "one two"),
        (6, "One two \U0001f600"),
        (7, long),
        (8, "x" * 200_000),
        (9, prose(60)),
        (9, prose(60)),
    ]
