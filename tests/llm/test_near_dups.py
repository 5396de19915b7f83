from collections import Counter, defaultdict

import pytest

from tillwork.llm import graph
from tillwork.llm.graph import components
from tillwork.llm.near_dups import SMALL_BUCKET, near_duplicates, one_of_each
from tillwork.llm.words import words
from tillwork.llm.workspace import Workspace
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401


def sets_of(rows, k):
    out = defaultdict(list)
    for doc_id, text in rows:
        w = words(text, lower=True)
        n = max(1, len(w) - k + 1)
        out[doc_id].append(frozenset(tuple(w[i : i + k]) for i in range(n)) if w else frozenset())
    return out


def expected(rows, k, percent):
    """By comparing all pairs."""
    sets = sets_of(rows, k)
    parent = {i: i for i in sets if i is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    flat = [(i, s) for i, ss in sets.items() if i is not None for s in ss if s]
    for n, (i, a) in enumerate(flat):
        for j, b in flat[:n]:
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    out = []
    for doc_id, text in rows:
        (size,) = {len(s) for s in sets_of([(doc_id, text)], k)[doc_id]}
        root = None if doc_id is None else find(doc_id)
        out.append((doc_id, size, root, doc_id is None or root == doc_id))
    return Counter(out)


def edited(prose, text, n):
    w = text.split()
    for _ in range(n):
        w[prose.draw.randrange(len(w))] = prose(1)
    return " ".join(w)


@pytest.mark.parametrize(("shingle", "percent"), [(3, 85), (5, 80), (1, 50)])
def test_groups(documents, prose, shingle, percent):
    bases = [prose(n) for n in (40, 90, 150, 3, 2, 1)]
    rows = [(n, prose(60)) for n in range(1, 30)]
    for n in range(90):
        base = bases[n % 6]
        rows.append((1000 - 7 * n, edited(prose, base, prose.draw.randint(0, 6))))
    # Chains: each text is the one before with a few words more.
    for n in range(15):
        rows.append((2000 + n, " ".join(bases[2].split()[: 60 + 6 * n])))
    got = Counter(tuples(near_duplicates(documents(rows), shingle, percent)))
    assert got == expected(rows, shingle, percent)


def test_a_group_larger_than_a_small_bucket(documents, prose):
    """Some copies are near enough to the base, some to other copies alone, some to none."""
    base = prose(200)
    rows = [(5000, base)]
    for n in range(4 * SMALL_BUCKET):
        rows.append((n + 1, edited(prose, base, n % 14)))
    for n in range(20):
        rows.append((3000 + n, edited(prose, rows[40 + 5 * n][1], 3)))
    got = Counter(tuples(near_duplicates(documents(rows), 3, 85)))
    assert got == expected(rows, 3, 85)


def test_edges(documents, prose):
    rows = edges(prose)
    got = Counter(tuples(near_duplicates(documents(rows), 3, 85)))
    assert got == expected(rows, 3, 85)


def test_empty_table(documents):
    assert tuples(near_duplicates(documents([]))) == []
    assert one_of_each(documents([])).count() == 0


def test_one_of_each_group_stays(documents, prose):
    rows = edges(prose) + [(20, prose(80))]
    rows += [(21 + n, edited(prose, rows[-1][1], 1)) for n in range(3)]
    docs = documents(rows)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    assert ids == Counter([None, None, 1, 2, 3, 4, 5, 6, 8, 9, 20])


@pytest.mark.parametrize("few", [0, 100_000])
def test_components(spark, prose, monkeypatch, few):
    monkeypatch.setattr(graph, "FEW", few)
    draw = prose.draw
    links = [(draw.randint(0, 300), draw.randint(0, 300)) for _ in range(170)]
    links += [(n, n + 1) for n in range(400, 520)] + [(600, n) for n in range(601, 700)] + [(7, 7)]
    parent = {n: n for pair in links for n in pair}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    got = components(spark.createDataFrame(links, "u long, v long"), Workspace(spark))
    assert dict(tuples(got)) == {n: find(n) for n in parent if find(n) != n}


def test_no_step_reads_its_input_many_times(documents, prose, monkeypatch):
    """The driver holds a step's plan anew after each of its stages."""
    leaves, put = [], Workspace.put

    def counted(self, df):
        leaves.append(df._jdf.queryExecution().optimizedPlan().collectLeaves().size())
        return put(self, df)

    monkeypatch.setattr(Workspace, "put", counted)
    base = prose(60)
    rows = [(n, edited(prose, base, n % 9)) for n in range(2 * SMALL_BUCKET)]
    assert Counter(tuples(near_duplicates(documents(rows), 3, 85))) == expected(rows, 3, 85)
    assert max(leaves) <= 12, str(leaves)
