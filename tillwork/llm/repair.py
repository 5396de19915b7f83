"""Damaged conversations put right by the cheapest edits, found by iterative-deepening A*.

A task walks through the rows of its conversations in order. It holds a bounded number of
rows: a longer conversation is solved in blocks, for every state of the grammar a block may
begin and end in, and only the best way into each state is carried on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Rows that are searched at once.
BLOCK = 32

SPACE = "\x20\t\n\x0b\x0c\r"
_COSTS = {"D": 4, "I": 3, "R": 3}
_UNFINISHED = 3

# What stands before: nothing, a system turn, a user turn, an assistant turn. The grammar
# ``(s?(ua)+)?`` allows a system turn at the start alone, and ends at the start or after an
# assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
ENDS = (START, ASSISTANT)
_NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": ASSISTANT},
    ASSISTANT: {"u": USER},
}
# The turn that an edit can make in each state.
_MADE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
# The states that can follow a state, and the least number of inserted turns in between.
_REACHED = {
    START: {START, SYSTEM, USER, ASSISTANT},
    SYSTEM: {SYSTEM, USER, ASSISTANT},
    USER: {USER, ASSISTANT},
    ASSISTANT: {USER, ASSISTANT},
}
_INSERTS = {
    START: {START: 0, USER: 1, ASSISTANT: 2},
    SYSTEM: {SYSTEM: 0, USER: 1, ASSISTANT: 2},
    USER: {USER: 0, ASSISTANT: 1},
    ASSISTANT: {ASSISTANT: 0, USER: 1},
}


@dataclass(frozen=True)
class Turn:
    """A row as the search sees it."""

    initial: str
    must_go: bool
    unfinished: bool


def _least_costs(turns: list[Turn], ends: tuple[int, ...]) -> tuple[list[int], list[tuple]]:
    """What the rows from each place on cost at least, and each place's next row that may stay.

    A row that must go costs a deletion, an unfinished one its surcharge. Of two neighbours
    whose initials may not follow each other one must change or go, or a turn must come
    between; pairs without a common row add up. The end counts as a neighbour of the last row.
    The second list holds, for each place, the next row that may stay, what that row and what
    follows it cost at least, and the least cost of rows before it.
    """
    n = len(turns)
    costs, nexts = [0] * (n + 1), [(None, 0, 0)] * (n + 1)
    legal = {"su", "ua", "au"} | {i + "." for i, s in (("s", 1), ("u", 2), ("a", 3)) if s in ends}
    row = None  # the next row that may stay: its initial, its surcharge, what follows it
    for i in range(n - 1, -1, -1):
        t = turns[i]
        if t.must_go:
            costs[i] = costs[i + 1] + _COSTS["D"]
            initial, after, before = nexts[i + 1]
            nexts[i] = (initial, after, before + _COSTS["D"])
            continue
        more = _UNFINISHED if t.unfinished else 0
        alone = more if t.initial in ("s", "u", "a") else min(_COSTS["R"] + more, _COSTS["D"])
        between = 0 if row is None else nexts[i + 1][2]
        initial, its_more, rest = row or (".", 0, 0)
        cost = alone + costs[i + 1]
        if t.initial + initial not in legal:
            change = _COSTS["I"] + more + its_more
            goes = _COSTS["D"] + (its_more if row is None else min(more, its_more))
            cost = max(cost, min(change, goes) + between + rest)
        costs[i] = cost
        row = (t.initial, more, costs[i + 1])
        nexts[i] = (t, costs[i + 1], 0)
    return costs, nexts


def cheapest_edits(turns: list[Turn], start: int, ends: tuple[int, ...]) -> tuple[int, str] | None:
    """The least cost, and the least string of edits among those of that cost.

    From state ``start`` to one of ``ends``; None if there is no way. Each bound on the cost
    is searched depth first, edits in ASCII order (delete, insert, keep, rerole), so the
    first way found is the least. A place and state that failed with some money left fails
    with less.
    """
    ends = tuple(e for e in ends if e in _REACHED[start])
    if ends in ((), (START,)):
        return (_COSTS["D"] * len(turns), "D" * len(turns)) if ends else None
    n = len(turns)
    least, nexts = _least_costs(turns, ends)

    def still(i: int, state: int) -> float:
        """What a place and state cost at least."""
        row, after, before = nexts[i]
        if row is None:
            return least[i] + _COSTS["I"] * min(_INSERTS[state].get(e, float("inf")) for e in ends)
        if _REACHED[state].isdisjoint(ends):
            return float("inf")
        if row.initial in _NEXT[state]:
            return least[i]
        more = _UNFINISHED if row.unfinished else 0
        return max(least[i], before + min(_COSTS["R"] + more, _COSTS["D"]) + after)

    bound = still(0, start)
    while bound < float("inf"):
        failed: dict[tuple[int, int], int] = {}
        over = float("inf")
        # The ways still to be tried, the next one on top.
        stack = [(0, start, int(bound), 0, "")]
        path: list[str] = []
        while stack:
            i, state, left, depth, letter = stack.pop()
            if letter:
                del path[depth:]
                path.append(letter)
            if i < 0:  # all ways out of a place and state have been tried
                failed[state] = max(failed.get(state, -1), left)
                continue
            if i == n and state in ends:
                return int(bound) - left, "".join(path)
            if failed.get((i, state), -1) >= left:
                continue
            stack.append((-1, (i, state), left, 0, ""))
            for letter, j, to, cost in reversed(_ways(turns, i, state)):
                more = cost + still(j, to) - left
                if more <= 0:
                    stack.append((j, to, left - cost, len(path), letter))
                else:
                    over = min(over, bound + more)
        bound = over
    return None


def _ways(turns: list[Turn], i: int, state: int) -> list[tuple[str, int, int, int]]:
    """The edits at a place and state in ASCII order: letter, next place, next state, cost."""
    ways = []
    made = _NEXT[state][_MADE[state][0]]
    if i < len(turns):
        ways.append(("D", i + 1, state, _COSTS["D"]))
    ways.append(("I", i, made, _COSTS["I"]))
    if i < len(turns) and not turns[i].must_go:
        more = _UNFINISHED if turns[i].unfinished else 0
        to = _NEXT[state].get(turns[i].initial)
        if to is not None:
            ways.append(("K", i + 1, to, more))
        if to != made:
            ways.append(("R", i + 1, made, _COSTS["R"] + more))
    return ways


class _Way:
    """The best way into a state: its cost, its edits, and the digest of what it leaves."""

    def __init__(self):
        self.cost, self.audit, self.digest, self.empty = 0, "", hashlib.sha256(), True

    def extended(self, state: int, cost: int, edits: str, rows: list[tuple[str, str]]) -> _Way:
        out = _Way()
        out.cost, out.audit = self.cost + cost, self.audit + edits
        out.digest, out.empty = self.digest.copy(), self.empty
        at = 0
        for letter in edits:
            role, text = rows[at] if letter != "I" else ("", "")
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = _MADE[state]
            state = _NEXT[state][role[0]]
            line = f"{role}:{text}" if out.empty else f"\n{role}:{text}"
            out.digest.update(line.encode("utf-8", "surrogatepass"))
            out.empty = False
        return out


class _Conversation:
    """What is known of a conversation up to some row."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.last = self.initial = None
        self.turns = 0
        self.ways = {START: _Way()}
        self.rows: list[tuple[str, str]] = []
        self.pending: list[Turn] = []

    def add(self, turn, role, text, blank, again, unfinished) -> None:
        if len(self.rows) == BLOCK:
            self._advance((START, SYSTEM, USER, ASSISTANT))
        fault = "blank" if blank else "duplicate" if again else "truncated" if unfinished else None
        if fault:
            self.counts[fault] += 1
        if turn is not None:
            self.turns += self.last != turn
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.initial is not None and self.initial + role[:1] not in ("su", "ua", "au"):
            self.counts["illegal"] += 1
        self.initial = role[:1]
        self.rows.append((role, text))
        self.pending.append(Turn(role[:1], blank or again, fault == "truncated"))

    def _advance(self, ends: tuple[int, ...]) -> None:
        """Solves the rows held and keeps the best way into each state they may end in."""
        best: dict[int, tuple] = {}
        for start, way in self.ways.items():
            for end in ends:
                found = cheapest_edits(self.pending, start, (end,))
                if found:
                    key = (way.cost + found[0], way.audit + found[1])
                    if end not in best or key < best[end][0]:
                        best[end] = (key, start, found)
        self.ways = {
            end: self.ways[start].extended(start, *found, self.rows)
            for end, (_, start, found) in best.items()
        }
        self.rows, self.pending = [], []

    def result(self) -> dict[str, object]:
        self._advance(ENDS)
        way = min(self.ways.values(), key=lambda w: (w.cost, w.audit))
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return {
            "conv_id": self.conv_id,
            "gaps": min(gaps, 2**63 - 1),
            **self.counts,
            "cost": way.cost,
            "audit": way.audit,
            "repaired_sha256": way.digest.hexdigest(),
        }


_NUMBERS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_TEXTS = ("audit", "repaired_sha256")
SCHEMA = ", ".join([f"{n} long" for n in _NUMBERS] + [f"{n} string" for n in _TEXTS])


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations, whose rows follow each other, to one row each."""
    target = pa.schema([(n, pa.int64()) for n in _NUMBERS] + [(n, pa.string()) for n in _TEXTS])
    open_: _Conversation | None = None
    for batch in batches:
        done = []
        columns = [batch.column(n).to_pylist() for n in batch.schema.names]
        for conv_id, gone, *row in zip(*columns, strict=True):
            if open_ is None or open_.conv_id != conv_id:
                if open_ is not None:
                    done.append(open_.result())
                open_ = _Conversation(conv_id)
            if not gone:
                open_.add(*row)
        yield pa.RecordBatch.from_pylist(done, target)
    if open_ is not None:
        yield pa.RecordBatch.from_pylist([open_.result()], target)


def damaged(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` after the damage, and ``gone`` for rows it drops.

    A missing field counts as one space. What happens to a row follows from the remainder of
    ``crc32("conv_id:turn")`` by 20: 0 drops it, 1 empties its text, 2 takes ``.``, ``!`` and
    ``?`` out of it, 3 puts it twice, 4 makes it a user's turn.
    """

    def filled(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    draw = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    text = filled("text")
    text = F.when(draw == 1, "").when(draw == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.when(draw == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.when(draw == 4, "user").otherwise(filled("role")).alias("role"),
        text.alias("text"),
        (draw == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


def repair(rows: DataFrame) -> DataFrame:
    """The faults and the repair of each conversation, as the columns of ``SCHEMA``.

    ``rows`` has ``conv_id``, ``turn``, ``role`` and ``text``, as ``damaged`` returns them: a
    row with ``gone`` only tells that its conversation exists; without that column all count.
    Rows follow by turn (missing turns first), then role, then text. A row's first fault
    counts: blank, a duplicate of an earlier row's role and text, or truncated, ending in
    none of ``.!?``.

    ``audit`` has the initials of the cheapest edits that give roles whose initials follow
    ``(s?(ua)+)?``: keep 0, rerole to user or assistant 3, delete 4 (a must for blank rows and
    duplicates), insert an empty user or assistant turn 3; a truncated row that stays costs 3
    more. Of equal costs the ASCII-least counts. ``repaired_sha256`` is of the ``role:text``
    lines that are left. A conversation without rows, or all of whose rows are gone, costs
    nothing. A missing ``conv_id`` is a conversation of its own; missing roles and texts
    count as one space. Any length is handled; a digest over one conversation takes one task,
    which holds ``BLOCK`` of its rows at a time.
    """
    gone = F.col("gone") if "gone" in rows.columns else F.lit(False)
    text, role = (F.coalesce(c, F.lit(" ")) for c in ("text", "role"))
    ending = F.rtrim(text, F.lit(SPACE))
    rows = rows.select("conv_id", gone.alias("gone"), "turn", role.alias("role"), text.alias("text"))
    rows = rows.select(
        "*",
        (ending == "").alias("blank"),
        (~F.right(ending, F.lit(1)).isin(".", "!", "?")).alias("unfinished"),
        F.xxhash64("role", "text").alias("alike"),
    )
    same = Window.partitionBy("conv_id", "gone", "alike", "role", "text").orderBy("turn")
    # Dealt by conversation once: the window and the walk only sort within the tasks.
    dealt = rows.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    ordered = dealt.sortWithinPartitions("conv_id", "turn", "role", "text").select(
        "conv_id", "gone", "turn", "role", "text", "blank", "again", "unfinished"
    )
    return ordered.mapInArrow(_repaired, SCHEMA)
