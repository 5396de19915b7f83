import zlib

import numpy as np
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401

from tillwork.llm.toxicity import Terms, fit, learn, toxicity, without_toxic

SCHEMA = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.1"


def test_pairs_mean_more_than_their_terms():
    """Toxic is an insult with a mention of a group; each alone is harmless."""
    draw = np.random.default_rng(5)
    rows, labels = [], []
    for n in range(2000):
        insult, group = n % 2, n // 2 % 2
        noise = 2 + draw.integers(0, 30, 5)
        rows.append(np.unique(np.r_[noise, [0] * insult, [1] * group]).astype(int))
        labels.append(float(insult and group))
    model = learn(rows, np.array(labels), np.arange(32))
    wrong = sum((model.score(r) >= 0.5) != bool(t) for r, t in zip(rows, labels, strict=True))
    assert wrong == 0
    assert model.factors[0] @ model.factors[1] > 0


def test_pairwise_sum():
    draw = np.random.default_rng(1)
    model = learn([np.array([0])] * 2, np.array([0.0, 1.0]), np.arange(6))
    model.linear, model.factors, model.bias = draw.normal(size=6), draw.normal(size=(6, 4)), 0.3
    at = [0, 2, 3, 5]
    want = 0.3 + model.linear[at].sum()
    want += sum(model.factors[a] @ model.factors[b] for a in at for b in at if a < b)
    assert abs(model.odds(np.array(at)) - want) < 1e-12


def test_terms_are_counted_once():
    terms = Terms()
    assert len(terms.of("Abc abc, ABC!")) == 1
    assert set(terms.of("abcd")) < set(terms.of("abcdx Abcd"))
    assert len(terms.of(None)) == len(terms.of(" -- ")) == 0


def test_held_out_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = toxicity(docs, labels).collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r["held_out"] and r["doc_id"] in known]
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
    toxic = [r["predicted"] for r in held if known[r["doc_id"]]]
    clean = [r["predicted"] for r in held if not known[r["doc_id"]]]
    # Some labels of these tables are wrong: toxic ones without a single telling word.
    assert sum(toxic) >= 0.9 * len(toxic) and sum(clean) <= 0.005 * len(clean)


def test_held_out_labels_are_not_learned(documents, table, prose):
    rows = [(n, ("vile " if n % 2 else "") + prose(20)) for n in range(200)]
    held = {n for n in range(200) if zlib.crc32(str(n).encode()) % 5 == 0}
    right = [(n, 1, n % 2) for n in range(200)]
    wrong = [(n, 1, 1 - n % 2 if n in held else n % 2) for n in range(200)]
    a = toxicity(documents(rows), table(right, SCHEMA)).orderBy("doc_id")
    b = toxicity(documents(rows), table(wrong, SCHEMA)).orderBy("doc_id")
    assert tuples(a) == tuples(b)
    assert [r["predicted"] for r in a.collect()] == [n % 2 for n in range(200)]


def test_edges(documents, table, prose):
    rows = edges(prose) + [(100 + n, f"{'vile' if n % 3 == 0 else 'kind'} {prose(30)}") for n in range(90)]
    labels = [(100 + n, None, int(n % 3 == 0)) for n in range(90)]
    labels += [(None, 1, 1), (5, 1, None), (100, 0, 0), (100, 1, 1), (9999, 1, 1)]
    got = tuples(toxicity(documents(rows), table(labels, SCHEMA)))
    assert sorted(r[0] for r in got if r[0]) == sorted(i for i, _ in rows if i)
    assert all(r[1] for r in got if r[0] is None)
    blank = {r[2] for r in got if r[0] in (1, 2, 3)}
    assert len(blank) == 1
    docs = documents(rows)
    clean = without_toxic(docs, table(labels, SCHEMA))
    assert clean.columns == docs.columns
    kept = {r["doc_id"] for r in clean.collect()}
    assert {100 + n for n in range(90) if n % 3} <= kept
    assert not {100 + n for n in range(90) if n % 3 == 0} & kept


def test_without_labels(documents, table, prose):
    docs = documents([(1, prose(10)), (2, None)])
    assert [r[2:] for r in tuples(toxicity(docs, table([], SCHEMA)))] == [(0.0, 0)] * 2
    one_class = [(n, 1, 0) for n in range(9)]
    assert [r[3] for r in tuples(toxicity(docs, table(one_class, SCHEMA)))] == [0, 0]
    assert tuples(toxicity(documents([]), table(one_class, SCHEMA))) == []


def test_a_labelled_id_with_many_rows_is_one_example(spark, documents, monkeypatch):
    """Whatever an id's rows, the task that learns gets one of them."""
    from tillwork.llm import toxicity as module

    seen = []
    real = module._trained

    def spy(rows, terms):
        seen.append(rows.count())
        return real(rows, terms)

    monkeypatch.setattr(module, "_trained", spy)
    rows = [(i, f"w{i % 7} {'bad' if i % 2 else 'good'} x{i}") for i in range(200)]
    rows += [(3, f"bad w{i}") for i in range(5_000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, toxic int")
    fit(documents(rows), labels, sample=50)
    assert seen and seen[0] <= 130
