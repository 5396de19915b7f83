import hashlib
from collections import Counter, defaultdict

import pytest
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401

from tillwork.llm.mixture import mixed_documents, mixture
from tillwork.llm.words import words


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """By sharing out what is left until no source is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    held = set()
    while True:
        left = share * sum(sizes.values()) - sum(most * sizes[s] for s in held)
        free = sum(weight[s] for s in names if s not in held)
        out = {s: most * sizes[s] if s in held else left * weight[s] / free for s in names}
        above = {s for s in names if out[s] > most * sizes[s] + 1e-9}
        if not above:
            return out
        held |= above


def expected(rows):
    """By sorting each source's rows."""
    sizes = defaultdict(int)
    by = defaultdict(lambda: defaultdict(int))
    sized = []
    for doc_id, text, source in rows:
        n = len(words(text))
        own = "" if doc_id is None else str(doc_id)
        draw = int(hashlib.md5(f"{own}:{text or ''}".encode()).hexdigest()[:15], 16)
        sizes[source] += n
        by[source][draw] += n
        sized.append((doc_id, n, source, draw))
    target = targets(sizes)
    below, whole = {}, {}
    for source, size in sizes.items():
        whole[source] = int(target[source] // size) if size else 0
        need = target[source] - whole[source] * size
        before, below[source] = 0, 0
        for draw, n in sorted(by[source].items()):
            if before + n > need:
                if before + n - need < need - before:
                    below[source] = draw + 1
                break
            before += n
            below[source] = draw + 1
    return [
        (i, n, sizes[s], target[s], n * (whole[s] + (draw < below[s]))) for i, n, s, draw in sized
    ]


def check(documents, rows):
    def listed(result):
        return sorted(
            ((i, n, s, round(t, 6), k) for i, n, s, t, k in result), key=lambda r: repr(r)
        )

    got = tuples(mixture(documents(rows)))
    assert listed(got) == listed(expected(rows))
    return got


@pytest.mark.parametrize("n", [3, 40, 1500])
def test_sources(documents, prose, n):
    draw = prose.draw
    rows = [
        (i, prose(draw.randint(0, 30)), draw.choice(["a", "a", "a", "b", "Z", "é", None, "d", "e"]))
        for i in range(n)
    ]
    got = check(documents, rows)
    taken, sizes = defaultdict(int), {}
    for _, size, source_size, target, took in got:
        assert took in (0, size, 2 * size)
        taken[source_size, target] += took
        sizes[source_size, target] = max(size, sizes.get((source_size, target), 0))
    for key, words_taken in taken.items():
        assert abs(words_taken - key[1]) <= sizes[key] / 2 + 1e-6 or n == 3


def test_edges(documents, prose):
    rows = [(*r, s) for r, s in zip(edges(prose), ["a", None, "b"] * 9, strict=False)]
    check(documents, rows)


def test_without_words(documents):
    got = tuples(mixture(documents([(1, None, "a"), (2, "", None)])))
    assert sorted(got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_empty_table(documents):
    assert tuples(mixture(documents([]))) == []
    assert mixed_documents(documents([])).count() == 0


def test_the_mix_holds_the_rows_taken(documents, prose):
    draw = prose.draw
    rows = [(i, prose(draw.randint(1, 9)), draw.choice("abc")) for i in range(300)]
    docs = documents(rows)
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    want = Counter({r[0]: r[4] // r[1] for r in tuples(mixture(docs))})
    assert Counter(r["doc_id"] for r in mixed.collect()) == +want


def test_no_python(spark):
    docs = spark.range(3).selectExpr("id AS doc_id", "'a b' AS text", "'s' AS source")
    for df in (mixture(docs), mixed_documents(docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
