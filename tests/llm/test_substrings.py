from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tillwork.llm.substrings import remove_repeats
from tillwork.llm.words import Rolling, WordHashes, minimizers, words
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401


def expected(rows, window):
    first = {}
    for doc_id, text in rows:
        tokens = words(text)
        for i in range(len(tokens) - window + 1):
            key = tuple(tokens[i : i + window])
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        tokens = words(text)
        gone = [False] * len(tokens)
        for i in range(len(tokens) - window + 1):
            if doc_id is not None and first[tuple(tokens[i : i + window])] < doc_id:
                gone[i : i + window] = [True] * window
        kept = b" ".join(t for t, g in zip(tokens, gone, strict=True) if not g)
        out.append((doc_id, len(tokens), sum(gone), kept.decode()))
    return Counter(out)


def check(documents, rows, window=50):
    assert Counter(tuples(remove_repeats(documents(rows), window))) == expected(rows, window)


def test_shared_passages(documents, prose):
    shared, other = prose(70), prose(50)
    rows = [(i, f"{prose(i % 40)} {shared} {prose(30)}") for i in range(1, 30)]
    rows += [(40 + i, f"{other} {prose(10)} {other}") for i in range(5)]
    rows += [(60, " ".join(shared.split()[:49])), (61, " ".join(shared.split()[5:55]))]
    rows += [(70 + i, "again " * (45 + 3 * i)) for i in range(4)]
    check(documents, rows)


def test_edges(documents, prose):
    check(documents, edges(prose))


def test_empty_table(documents):
    assert tuples(remove_repeats(documents([]))) == []


@pytest.mark.parametrize("window", [2, 3, 7, 10])
def test_short_windows(documents, prose, window):
    draw = prose.draw
    rows = [(draw.randint(1, 25), " ".join(draw.choices("ab", k=draw.randint(0, 40)))) for _ in range(40)]
    check(documents, rows, window)


@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 8))
@settings(max_examples=50, suppress_health_check=list(HealthCheck))
def test_equal_windows_have_equal_hashes(values, length):
    tokens = [b"%d" % v for v in values]
    hashes = Rolling(3).windows(WordHashes().of(tokens), length)
    seen = {}
    for i, h in enumerate(hashes.tolist()):
        assert seen.setdefault(h, tokens[i : i + length]) == tokens[i : i + length]
    assert len(seen) == len({tuple(tokens[i : i + length]) for i in range(len(hashes))})


def test_minimizers_are_picked_alike_in_equal_runs(prose):
    import numpy as np

    draw = np.random.default_rng(1)
    run = draw.integers(0, 50, 30).astype(np.uint64)
    a = np.r_[draw.integers(0, 50, 13).astype(np.uint64), run]
    b = np.r_[run, draw.integers(0, 50, 17).astype(np.uint64)]
    for at in range(30 - 9):
        here = {p - 13 for p in minimizers(a, 10).tolist()} & set(range(at, at + 10))
        there = set(minimizers(b, 10).tolist()) & set(range(at, at + 10))
        assert here & there


def test_many_rows_of_one_id(documents, prose):
    """Copies of one row, and many texts under one id that share passages with others."""
    shared = prose(60)
    rows = [(5, shared)] * 2_000 + [(3, f"{prose(4)} {shared}")]
    rows += [(7, f"{prose(3)} {shared} {prose(i % 9)}") for i in range(300)]
    rows += [(8, f"{' '.join(shared.split()[:52])}  {prose(2)}"), (8, shared.replace(" ", "  "))]
    check(documents, rows)
