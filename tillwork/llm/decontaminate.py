"""Finds benchmark items in documents, up to a few edits."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.workspace import map_batches

# Characters of benchmark text that one pass over the documents looks for.
BLOCK_CHARS = 4_000_000
# Items longer than this are looked for by segments of at most so many characters.
SEGMENT = 800


def normal(text: str | None) -> str:
    """Lower case, with single spaces between words."""
    return " ".join((text or "").lower().split())


def budget(length: int, percent: int, most: int | None = None) -> int:
    """Edits allowed in an item of so many characters, ``most`` if that is given and less."""
    edits = length * percent // 100
    return edits if most is None else min(edits, most)


def pieces(item: str, edits: int) -> list[tuple[int, str]]:
    """The item cut into ``edits + 1`` even pieces, with their offsets.

    An edit spoils one piece at most, so a text within ``edits`` of the item has one of
    the pieces unchanged.
    """
    cuts = [len(item) * i // (edits + 1) for i in range(edits + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class Pattern:
    """Myers' bit-parallel distance of an item to the best part of a text."""

    def __init__(self, item: str):
        self.size = len(item)
        self.masks: dict[str, int] = defaultdict(int)
        for i, c in enumerate(item):
            self.masks[c] |= 1 << i

    def nearest(self, text: str) -> tuple[int, int]:
        """The least edit distance of the item to any part of ``text``, and where the first
        such part ends."""
        masks, full, top = self.masks, (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score = full, 0, self.size
        best, end = score, 0
        for i, c in enumerate(text):
            eq = masks.get(c, 0)
            down = eq | minus
            across = (((eq & plus) + plus) ^ plus) | eq
            up_plus = minus | (~(across | plus) & full)
            up_minus = plus & across
            if up_plus & top:
                score += 1
            elif up_minus & top:
                score -= 1
            up_plus = (up_plus << 1) & full
            up_minus = (up_minus << 1) & full
            plus = up_minus | (~(down | up_plus) & full)
            minus = up_plus & down
            if score < best:
                best, end = score, i + 1
        return best, end


def segments(item: str, edits: int) -> list[tuple[int, str, int]]:
    """The item cut into even segments: their offsets, texts and edits.

    Of a text within ``edits`` of the item, some segment's share is within its edits: if
    each had one more, they would add up to more than ``edits``.
    """
    n = max(1, -(-len(item) // SEGMENT))
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b], edits // n) for a, b in zip(cuts, cuts[1:], strict=False)]


def _merged(stretches: list[list[int]]) -> list[list[int]]:
    """Stretches of a text in order, those that meet or overlap as one."""
    out: list[list[int]] = []
    for first, until in sorted(stretches):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], until)
        else:
            out.append([first, until])
    return out


def searcher(items: list[str], percent: int, most: int | None = None):
    """A function from a text to the items in it: their positions and least distances."""
    where = defaultdict(list)
    edits = [budget(len(item), percent, most) for item in items]
    # Each segment: its item, offset, text and edits. A short item is one segment.
    parts = [(n, *s) for n, item in enumerate(items) for s in segments(item, edits[n])]
    alone = [len(part) == len(items[n]) for n, _, part, _ in parts]
    patterns: dict[str, Pattern] = {}
    for m, (_, _, part, allowed) in enumerate(parts):
        for offset, piece in pieces(part, allowed):
            where[piece].append((m, offset))
    search = ahocorasick.Automaton()
    for piece, places in where.items():
        search.add_word(piece, (len(piece), places))
    search.make_automaton()

    def nearest(item: str, text: str) -> int:
        if item not in patterns:
            patterns[item] = Pattern(item)
        return patterns[item].nearest(text)[0]

    def found(text: str) -> dict[int, int]:
        # For each segment, the stretches of text in which a hit says that it may lie.
        hit = defaultdict(list)
        for last, (size, places) in search.iter(text):
            for m, offset in places:
                _, _, part, allowed = parts[m]
                begin = last + 1 - size - offset
                first, until = max(0, begin - allowed), begin + len(part) + allowed
                near = hit[m][-1] if hit[m] else None
                if near and first <= near[1] and until >= near[0]:
                    near[:] = min(near[0], first), max(near[1], until)
                else:
                    hit[m].append([first, until])
        # For each item, the stretches in which it may lie, by the segments that are there.
        stretches = defaultdict(list)
        exact = {}
        for m, places in hit.items():
            n, offset, part, allowed = parts[m]
            if n not in exact:
                exact[n] = items[n] in text
            if exact[n]:
                continue
            for first, until in places:
                if alone[m]:
                    stretches[n].append([first, until])
                elif nearest(part, text[first:until]) <= allowed:
                    # The segment begins and ends inside; the item's other edits come on top.
                    more = len(items[n]) - offset - len(part) + edits[n]
                    stretches[n].append([max(0, first - offset - edits[n]), until + more])
        best = {n: 0 for n in exact if exact[n]}
        for n, places in stretches.items():
            least = min(nearest(items[n], text[a:b]) for a, b in _merged(places))
            if least <= edits[n]:
                best[n] = least
        return best

    return found


def _blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items that have a text, some ``BLOCK_CHARS`` characters at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).filter(
        "item_id IS NOT NULL AND text IS NOT NULL"
    )
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_CHARS)
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        known = sorted({(r["item_id"], normal(r["text"])) for r in part.collect()})
        if known := [k for k in known if k[1]]:
            yield known


def contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = 8, most: int | None = None
) -> DataFrame:
    """The documents that contain a benchmark item, up to a few edited characters.

    ``docs`` has ``doc_id`` and ``text``, ``benchmark`` has ``item_id`` and ``text``; other
    columns are not read. Both texts are lowered and their white space is made single
    spaces. An item of n characters is in a document if some part of the document is
    within ``n * percent / 100`` edits (one character put in, left out or changed), whatever
    its length, or ``most`` if that is given and less. Returns ``doc_id, item_id, distance`` (the least of any part), one row for
    each pair of a row of ``docs`` and an item that match. A short item is matched like a
    long one, down to equality.

    Items without text or id match nothing; nor do documents without text. Documents
    without an id are reported with a null. Rows repeated in ``benchmark`` count once;
    different texts under one id are items of their own, and the least distance counts.

    The benchmark is taken in blocks of ``BLOCK_CHARS`` characters, each a pass over all
    documents; only a block is ever in memory.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    schema = "doc_id long, item_id long, distance int"
    result = docs.sparkSession.createDataFrame([], schema)
    for items in _blocks(benchmark):

        def make(items=items):
            found = searcher([text for _, text in items], percent, most)

            def convert(rows):
                out = []
                for doc_id, text in zip(rows["doc_id"], rows["text"], strict=True):
                    best = {}
                    for n, distance in found(normal(text)).items():
                        item = items[n][0]
                        best[item] = min(distance, best.get(item, distance))
                    out += [(doc_id, item, distance) for item, distance in best.items()]
                doc_ids, item_ids, distances = zip(*out, strict=True) if out else ([], [], [])
                return {"doc_id": doc_ids, "item_id": item_ids, "distance": distances}

            return convert

        result = result.unionByName(map_batches(docs, schema, make))
    return result


def without_contaminated(
    docs: DataFrame, benchmark: DataFrame, percent: int = 8, most: int | None = None
) -> DataFrame:
    """The rows of ``docs`` that contain no benchmark item; see ``contaminated``.

    All columns stay. Each row is judged by its own text, where it lies: nothing is shuffled.
    """
    for items in _blocks(benchmark):
        docs = docs.filter(_is_clean([text for _, text in items], percent, most)("text"))
    return docs


def _is_clean(items: list[str], percent: int, most: int | None):
    @F.pandas_udf("boolean")
    def is_clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = searcher(items, percent, most)
        for texts in batches:
            yield pd.Series([not found(normal(t)) for t in texts], dtype=bool)

    return is_clean
