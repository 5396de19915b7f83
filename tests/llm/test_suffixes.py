from collections import Counter

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401
from tillwork.llm import suffixes
from tillwork.llm.suffixes import Strings, _anchors, _groups, _without, remove_repeated_bytes
from tillwork.llm.words import Rolling
from tillwork.llm.workspace import Workspace


def expected(rows, length):
    first = {}
    raws = [(doc_id, (text or "").encode()) for doc_id, text in rows]
    for doc_id, raw in raws:
        for i in range(len(raw) - length + 1):
            key = raw[i : i + length]
            if doc_id is not None:
                first[key] = min(first.get(key, doc_id), doc_id)
    out = Counter()
    for doc_id, raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if doc_id is not None and first[raw[i : i + length]] < doc_id:
                gone[i : i + length] = b"\1" * length
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc_id, len(raw), sum(gone), spans, kept] += 1
    return out


def check(documents, rows, length=50, gram=18):
    got = tuples(remove_repeated_bytes(documents(rows), length, gram))
    assert Counter((*r[:4], bytes(r[4])) for r in got) == expected(rows, length)


def test_shared_strings(documents, prose):
    shared, other = prose(20), prose(12)
    rows = [(i, f"{prose(i % 40)}{shared}{prose(30)}") for i in range(1, 30)]
    rows += [(40 + i, f"{other} {prose(10)} {other}") for i in range(5)]
    rows += [(60, shared[:49]), (61, shared[3:53]), (62, shared[1:51] + "z")]
    rows += [(70 + i, "again " * (8 + 3 * i)) for i in range(4)]
    rows += [(80, "x" * 51), (81, "x" * 49), (82, "x" * 120), (83, "y" + "x" * 50 + "y")]
    check(documents, rows)


@pytest.mark.parametrize("run", [1, 3, 50_000])
def test_parts_of_a_very_common_gram(documents, prose, monkeypatch, run):
    """Strings around one passage in all documents, whose neighbourhoods all differ."""
    monkeypatch.setattr(suffixes, "RUN", run)
    monkeypatch.setattr(suffixes, "_CHUNK", 5)
    passage = prose(12)[:60]
    rows = [(i, f"{prose(8)}{'ab'[i % 2] * 6}{passage}{'cd'[i % 3 == 0] * 9}{prose(9)}") for i in range(1, 60)]
    check(documents, rows)


@pytest.mark.parametrize("run", [1, 7, 50_000])
def test_equal_contexts_in_several_parts(documents, prose, monkeypatch, run):
    """Copies of a context are dealt to parts as well, and still only the first one stays."""
    monkeypatch.setattr(suffixes, "RUN", run)
    monkeypatch.setattr(suffixes, "_CHUNK", 3)
    passage = prose(40)
    rows = [(i, f"{prose(3)}{passage}{prose(i % 4)}") for i in range(50, 20, -1)]
    rows += [(22, f"{passage} {prose(2)}"), (60, f"{passage}{passage}"), (21, passage[30:90])]
    check(documents, rows)


def test_context_bytes_are_written_and_shuffled_once(documents, prose, monkeypatch):
    """The strings around the anchors are the bulk of the job; they are kept in one table only."""
    staged, real = [], Workspace.put

    def spy(self, df):
        staged.append(df.columns)
        return real(self, df)

    monkeypatch.setattr(Workspace, "put", spy)
    shared = prose(40)
    check(documents, [(i, f"{prose(9)}{shared}{prose(i)}") for i in range(12)])
    assert sum("context" in columns for columns in staged) == 1


@given(st.integers(1, 60), st.lists(st.tuples(st.integers(0, 59), st.integers(1, 60)), min_size=1))
@settings(max_examples=200, deadline=None)
def test_spans_that_overlap_or_touch_are_one_run(size, pairs):
    raw = bytes(range(size))
    spans = [(a % size, min(a % size + n, size)) for a, n in pairs]
    gone = [any(a <= i < b for a, b in spans) for i in range(size)]
    runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
    kept = bytes(b for b, g in zip(raw, gone) if not g)
    assert _without(raw, np.array([(a << 32) | b for a, b in spans], np.int64)) == (runs, kept)


@pytest.mark.parametrize("together", [1, 300, 2**16])
def test_anchors_of_texts_hashed_together(monkeypatch, prose, together):
    """Texts laid end to end have the anchors they have alone, and none across their ends."""
    monkeypatch.setattr(suffixes, "_TOGETHER", together)
    raws = [t.encode() for t in (prose(30), "", "x" * 49, "x" * 50, prose(3), prose(80), "y" * 120, "")]
    rolling = Rolling(18)
    alone = [(n, *row) for n, raw in enumerate(raws) for row in zip(*_anchors([raw], rolling, 50, 18)[1:])]
    joint = []
    for start, end in _groups([len(r) for r in raws]):
        text, *rest = _anchors(raws[start:end], rolling, 50, 18)
        joint += zip(text + start, *rest)
    assert [tuple(map(int, r)) for r in joint] == [tuple(map(int, r)) for r in alone]
    assert {int(r[0]) for r in joint} == {n for n, raw in enumerate(raws) if len(raw) >= 50}


def test_edges(documents, prose):
    check(documents, edges(prose))


def test_empty_table(documents):
    assert tuples(remove_repeated_bytes(documents([]))) == []


@pytest.mark.parametrize(("length", "gram"), [(2, 1), (3, 2), (7, 3), (10, 9)])
def test_short_strings(documents, prose, length, gram):
    draw = prose.draw
    rows = [(draw.randint(1, 25), "".join(draw.choices("abé\0", k=draw.randint(0, 40)))) for _ in range(60)]
    check(documents, rows, length, gram)


def test_many_rows_of_one_id_and_text(documents, prose):
    text = prose(40)
    rows = [(5, text)] * 3_000 + [(5, prose(10) + text[:100])] + [(9, text[20:]), (3, text[:80])]
    check(documents, rows)


def test_no_text_is_pushed_aside_by_its_own_copies(documents, prose):
    text = prose(30)
    check(documents, [(7, f"{text}{text}"), (7, text), (8, "ü" * 60), (8, "ü" * 60)])


@given(st.lists(st.binary(min_size=1, max_size=12), min_size=1, max_size=30), st.integers(1, 4))
@settings(max_examples=100, deadline=None, suppress_health_check=list(HealthCheck))
def test_sort_and_common_extension(parts, groups):
    parts = [bytes(b % 3 for b in p) for p in parts]
    strings = Strings(parts)
    at, end = strings.starts[:-1], strings.starts[1:]
    group = np.sort(np.arange(len(parts)) % groups)
    order = strings.sort(at, end, group).tolist()
    assert sorted(order) == list(range(len(parts)))
    keys = [(group[i], parts[i].ljust(12, b"\0")) for i in order]
    assert keys == sorted(keys)
    a, b = at[:-1], at[1:]
    most = np.minimum(end[:-1] - a, end[1:] - b)
    for x, y, k, n in zip(parts, parts[1:], strings.common(a, b, most).tolist(), most.tolist()):
        assert x[:k] == y[:k] and (k == n or x[k] != y[k])


def test_collisions_are_found_and_put_right(documents, prose, monkeypatch):
    """With hashes that cannot tell strings apart, the verification still sorts the bytes."""
    monkeypatch.setattr(Strings, "_hash", lambda self, at, size: size)
    parts = [b"banana", b"bandana", b"bababa", b"zz", b"a"]
    strings = Strings(parts)
    order = strings.sort(strings.starts[:-1], strings.starts[1:], np.zeros(5, np.int64))
    assert [parts[i] for i in order] == sorted(parts)


def test_contexts_only_of_shared_grams(spark, documents, prose, monkeypatch):
    """What has no gram in common with another document never reaches the sort."""
    seen = []
    real = suffixes._contexts

    def spy(texts, length, gram):
        out = real(texts, length, gram)
        seen.extend(r[0] for r in tuples(out.select("doc_id")))
        return out

    monkeypatch.setattr(suffixes, "_contexts", spy)
    shared = prose(30)
    rows = [(i, prose(200)) for i in range(20)] + [(30, shared), (31, f"{shared}!")]
    remove_repeated_bytes(documents(rows))
    sizes = Counter(seen)
    assert sizes[30] > 5 and sum(sizes.values()) < 2 * (sizes[30] + sizes[31]) + 200
