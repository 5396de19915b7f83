from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import documents, edges, prose, table, tuples  # noqa: F401

from tillwork.llm import decontaminate
from tillwork.llm.decontaminate import (
    Pattern,
    budget,
    contaminated,
    normal,
    pieces,
    without_contaminated,
)

SCHEMA = "item_id long, text string"


def distance(item, text):
    """The least edit distance to any part, by the full table."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item):
        new = [i + 1]
        for j, b in enumerate(text):
            new.append(min(row[j] + (a != b), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def expected(rows, items, percent=8, most=64):
    out = Counter()
    known = {}
    for item_id, text in items:
        if item_id is not None and normal(text):
            known.setdefault(item_id, set()).add(normal(text))
    for doc_id, text in rows:
        for item_id, texts in known.items():
            found = [
                d
                for t in texts
                if (d := distance(t, normal(text))) <= budget(len(t), percent, most)
            ]
            if found:
                out[doc_id, item_id, min(found)] += 1
    return out


@given(st.text("ab", min_size=1, max_size=9), st.text("ab", max_size=25))
@settings(max_examples=300)
def test_distance(item, text):
    assert Pattern(item).nearest(text)[0] == distance(item, text)


def test_pieces_cover_the_item():
    for n in range(1, 60):
        item = "".join(chr(97 + i % 26) for i in range(n))
        for edits in range(min(n, 9)):
            cut = pieces(item, edits)
            assert "".join(p for _, p in cut) == item and len(cut) == edits + 1
            assert all(p and item[o : o + len(p)] == p for o, p in cut)


def edit(draw, text, n):
    for _ in range(n):
        at = draw.randrange(len(text))
        text = draw.choice([text[:at] + text[at + 1 :], text[:at] + "q" + text[at:], text[:at] + "z" + text[at + 1 :]])
    return text


def test_matches(documents, table, prose):
    draw = prose.draw
    items = [(n, prose(draw.randint(4, 25))) for n in range(8)]
    items += [(3, prose(12)), (8, items[0][1]), (9, None), (None, prose(9)), (10, " "), items[1]]
    rows = [(n, prose(60)) for n in range(10)]
    for n in range(40):
        item = items[n % 9][1]
        text = edit(draw, item, draw.randint(0, len(item) // 9))
        rows.append((100 + n, f"{prose(20)} {text.upper() if n % 5 == 0 else text} \n{prose(9)}"))
    rows += [(200, items[2][1][: len(items[2][1]) // 2]), (201, items[0][1]), (201, items[0][1])]
    rows += [(None, items[4][1]), (300, None), (301, "")]
    got = Counter(tuples(contaminated(documents(rows), table(items, SCHEMA))))
    want = expected(rows, items)
    assert got == want
    assert len({k[2] for k in want}) > 2


def test_blocks_and_filter(documents, table, prose, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    items = [(n, prose(15)) for n in range(12)]
    rows = edges(prose) + [(50 + n, f"{prose(5)} {t} {prose(5)}") for n, t in items]
    docs, benchmark = documents(rows), table(items, SCHEMA)
    assert Counter(tuples(contaminated(docs, benchmark))) == expected(
        [r for r in rows if len(r[1] or "") < 10_000], items
    )
    clean = without_contaminated(docs, benchmark)
    assert clean.columns == docs.columns
    assert Counter(r["doc_id"] for r in clean.collect()) == Counter(i for i, _ in edges(prose))


def test_empty_tables(documents, table, prose):
    docs = documents([(1, prose(20))])
    assert tuples(contaminated(docs, table([], SCHEMA))) == []
    assert without_contaminated(docs, table([], SCHEMA)).count() == 1
    assert tuples(contaminated(documents([]), table([(1, "a b")], SCHEMA))) == []


def test_long_items_have_the_same_share(documents, table, prose):
    """Edits are a share of the length beyond 800 characters too, spread out or in one place."""
    draw = prose.draw
    items = [(n, prose(words)[:size]) for n, (words, size) in enumerate([(300, 900), (400, 1700)])]
    rows = []
    for n, item in items:
        for share in (2, 7, 12):
            text = edit(draw, item, len(item) * share // 100)
            rows.append((1000 + 100 * n + share, f"{prose(30)} {text} {prose(30)}"))
        gap = len(item) * 6 // 100
        rows.append((100 + n, f"{prose(9)} {item[:500]}{item[500 + gap :]} {prose(9)}"))
        rows.append((200 + n, f"{prose(9)} {item[: len(item) * 4 // 5]} {prose(90)}"))
        rows.append((300 + n, f"{prose(9)} {item.upper()} {prose(9)}"))
    docs, benchmark = documents(rows), table(items, SCHEMA)
    want = expected(rows, items, most=10_000)
    assert Counter(tuples(contaminated(docs, benchmark))) == want
    assert max(d for _, _, d in want) > 64
    kept = {r["doc_id"] for r in without_contaminated(docs, benchmark).collect()}
    assert kept == {i for i, _ in rows} - {i for i, _, _ in want}
    assert {1012, 1112, 200, 201} <= kept


def test_segments_share_the_edits():
    for n in (1, 799, 800, 801, 1600, 1601, 12_345):
        item = "".join(chr(97 + i % 26) for i in range(n))
        for edits in (0, 1, n // 50, n * 8 // 100):
            cut = decontaminate.segments(item, edits)
            assert "".join(part for _, part, _ in cut) == item
            assert all(item[o : o + len(part)] == part and len(part) <= 800 for o, part, _ in cut)
            assert sum(allowed + 1 for _, _, allowed in cut) > edits
