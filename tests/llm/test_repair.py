import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from llm_fixtures import table, tuples  # noqa: F401
from tillwork.llm import repair as module
from tillwork.llm.repair import ENDS, START, Turn, cheapest_edits, damaged, repair

SCHEMA = "conv_id long, turn long, role string, text string"
GRAMMAR = re.compile(r"(s?(ua)+)?")
SPACES = " \t\n\v\f\r"


def all_edits(rows):
    """Every way to edit up to three rows with up to three insertions: cost, audit, lines."""
    for edits in product("DKR", repeat=len(rows)):
        for gaps in product(range(4), repeat=len(rows) + 1):
            if sum(gaps) > 3:
                continue
            audit, cost, slots = "", 3 * sum(gaps), []
            for i in range(len(rows) + 1):
                audit += "I" * gaps[i]
                slots += [(("user", "assistant"), "")] * gaps[i]
                if i == len(rows):
                    continue
                role, text, must_go, unfinished = rows[i]
                audit += edits[i]
                if edits[i] == "D":
                    cost += 4
                    continue
                if must_go:
                    break
                cost += 3 * unfinished + 3 * (edits[i] == "R")
                slots.append(((role,) if edits[i] == "K" else ("user", "assistant"), text))
            else:
                for roles in product(*[s[0] for s in slots]):
                    if GRAMMAR.fullmatch("".join(r[:1] or "-" for r in roles)):
                        lines = [f"{r}:{t}" for r, (_, t) in zip(roles, slots)]
                        yield cost, audit, "\n".join(lines)


def expected(rows):
    """The definition: damage, faults, and the least of all edits."""
    out = {}
    for conv_id in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv_id]:
            role, text = (" " if x is None else x for x in (role, text))
            key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
            fate = zlib.crc32(key.encode()) % 20
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            row = (turn, "user" if fate == 4 else role, text)
            kept += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        counts, seen, faced = dict(blank=0, duplicate=0, truncated=0), set(), []
        for _, role, text in kept:
            body = text.rstrip(SPACES)
            fault = None
            if not body:
                fault = "blank"
            elif (role, text) in seen:
                fault = "duplicate"
            elif body[-1] not in ".!?":
                fault = "truncated"
            seen.add((role, text))
            if fault:
                counts[fault] += 1
            faced.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, _, _ in kept if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[:1] for _, r, _ in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        out[conv_id] = (gaps, *counts.values(), illegal, faced)
    return out


def check(table, rows):
    """Counts of all conversations; edits of those short enough to try them all."""
    names = "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256".split()
    got = {r[0]: r[1:] for r in tuples(repair(damaged(table(rows, SCHEMA))).select(*names))}
    want = expected(rows)
    assert set(got) == set(want)
    for conv_id, (*counts, faced) in want.items():
        assert list(got[conv_id][:5]) == counts, conv_id
        if len(faced) <= 3:
            cost, audit, text = min(all_edits(faced))
            digest = hashlib.sha256(text.encode()).hexdigest()
            assert got[conv_id][5:] == (cost, audit, digest), conv_id
    return got


def test_short_conversations(table):
    r = random.Random(1)
    texts = ["a.", "b!", "c", " ", "", None, "b!", "d? \n", "é ?x"]
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    rows = [
        (c, t, r.choice(roles), r.choice(texts))
        for c in range(300)
        for t in r.sample([None, 0, 1, 2, 3, 7, -4], r.randint(1, 3))
    ]
    check(table, rows)


def test_edges(table):
    rows = [
        (None, 0, "user", "x."), (None, None, None, None),
        (1, None, "user", "x."), (1, None, "user", "x."), (1, 0, "assistant", "y" * 300_000),
        (2, -(2**63), "user", "a."), (2, 2**63 - 1, "assistant", "b."),
        (3, 5, "user", "same."), (3, 5, "user", "same."), (3, 5, "assistant", "same."),
        (-4, 1, "", ""), (5, 1, "user", ". . ." * 1000 + " " * 100_000),
    ]
    got = check(table, [r for r in rows if r[0] != 2])
    assert len(got) == 5
    wide = tuples(repair(damaged(table(rows, SCHEMA))).filter("conv_id = 2").select("gaps"))
    assert wide[0][0] in (0, 2**63 - 1)


def test_empty_table(table):
    assert tuples(repair(damaged(table([], SCHEMA)))) == []


def test_all_rows_dropped(table):
    gone = [(c, 0, "user", "x.") for c in range(200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = tuples(repair(damaged(table(gone, SCHEMA))))
    nothing = hashlib.sha256(b"").hexdigest()
    assert gone and {r[1:] for r in got} == {(0, 0, 0, 0, 0, 0, "", nothing)}


@pytest.mark.parametrize("block", [1, 2, 5])
def test_blocks_change_nothing(table, monkeypatch, block):
    """A long conversation solved in small blocks gives what one block gives."""
    r = random.Random(block)
    roles = ["system"] + ["user", "assistant"] * 9 + ["user"] * 4 + ["assistant"] * 3
    rows = [(c, t, r.choice(roles[t % 25 :]), r.choice(["a.", f"{t}!", f"{t}"])) for c in range(30) for t in range(28)]
    monkeypatch.setattr(module, "BLOCK", 100)
    want = tuples(_local(rows))
    monkeypatch.setattr(module, "BLOCK", block)
    assert tuples(_local(rows)) == want


class _local:
    """The walk of one task, without Spark."""

    def __init__(self, rows):
        self.rows = rows

    def collect(self):
        out = []
        for c in sorted({r[0] for r in self.rows}):
            conversation = module._Conversation(c)
            seen = set()
            for _, turn, role, text in [r for r in self.rows if r[0] == c]:
                again = (role, text) in seen
                seen.add((role, text))
                conversation.add(turn, role, text, not text.strip(), again, text[-1] not in ".!?")
            out.append(conversation.result().values())
        return out


def test_a_long_conversation_takes_little_time(table):
    r = random.Random(3)
    rows = [(1, t, r.choice(["user", "assistant"]), f"{t}.") for t in range(20_000)]
    rows += [(c, t, "user", f"{t}.") for c in range(2, 40) for t in range(3)]
    got = {x[0]: x for x in tuples(repair(damaged(table(rows, SCHEMA))))}
    assert len(got) == 39
    audit = got[1][7]
    assert len(audit.replace("I", "")) == sum(
        {0: 0, 3: 2}.get(zlib.crc32(f"1:{t}".encode()) % 20, 1) for t in range(20_000)
    )


def _cheapest(turns):
    """All states and costs at once, in order of cost and edits."""
    import heapq

    heap, done = [(0, "", 0, START)], set()
    while True:
        cost, audit, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in ENDS:
            return cost, audit
        for letter, j, to, more in module._ways(turns, i, state):
            heapq.heappush(heap, (cost + more, audit + letter, j, to))


@given(st.lists(st.builds(Turn, st.sampled_from("suuax "), st.booleans(), st.booleans()), max_size=12))
@settings(max_examples=300, deadline=None)
def test_search_finds_the_least_edits(turns):
    assert cheapest_edits(turns, START, ENDS) == _cheapest(turns)
