"""Finds secrets in texts, by known shapes and by entropy, with DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.scans import let, running, shifted

# Fixed patterns; a match shorter than its least length is dropped.
ASSIGN = (
    r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}
KINDS = ("assign", "access", "hex", "entropy")

# Strings of at least this many characters are looked at for entropy, and so long is the
# window that slides over them.
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-="
# Bits for each character that some window must exceed, by character class: strings of
# hexadecimal digits, and all others.
HEX_BITS = 3.01
MIXED_BITS = 3.71
# A candidate that matches one of these is no secret: words and numbers, names joined by
# hyphens or underscores, paths, identifiers in the usual 8-4-4-4-12 form, examples.
ALLOWED = (
    r"^[A-Za-z/_=+-]*$",
    r"^[0-9/_=+-]*$",
    r"^([A-Za-z]+|[0-9]+)([_/-]+([A-Za-z]+|[0-9]+))*$",
    r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
    r"(?i)example|placeholder|dummy|xxxx|0000|1234567",
)

_SPAN = "struct<at:int,rank:int,end:int,hit:string>"
_NO_SPANS = f"array<{_SPAN}>"
_FAR = 2**31 - 1


def _sum(a: Column, b: Column) -> Column:
    return a + b


def _spans(text: Column, kind: str, pattern: str, least: int, value: int) -> Column:
    """Leftmost matches that do not overlap, as spans in code points.

    Each match is taken together with the gap before it, and the end of the text counts
    as a last match, so the lengths add up to places. ``value`` is the group whose length
    counts, 2 for the whole match. A text without a match is only searched.
    """
    together = F.lit(rf"(?s)(.*?)({pattern}|\z)")
    groups = [1, 2] if value == 2 else [1, 2, value]

    def placed(parts: Column) -> Column:
        lengths = F.transform(parts, lambda p: F.length(p["gap"]) + F.length(p["hit"]))
        spans = F.zip_with(
            parts,
            running(lengths, _sum),
            lambda p, end: F.struct(
                (end - F.length(p["hit"])).alias("at"),
                F.lit(KINDS.index(kind)).alias("rank"),
                end.alias("end"),
                p["hit"].alias("hit"),
                F.length(p[f"g{value}"]).alias("size"),
            ),
        )
        long = F.filter(spans, lambda s: s["size"] >= least)
        return F.transform(long, lambda s: F.struct(s["at"], s["rank"], s["end"], s["hit"]).cast(_SPAN))

    names = {1: "gap", 2: "hit", value: "hit" if value == 2 else f"g{value}"}
    parts = F.arrays_zip(
        *[F.regexp_extract_all(text, together, F.lit(g)).alias(names[g]) for g in groups]
    )
    if value == 2:
        parts = F.transform(
            parts, lambda p: F.struct(p["gap"].alias("gap"), p["hit"].alias("hit"), p["hit"].alias("g2"))
        )
    found = let(parts, placed)
    return F.when(F.regexp_like(text, F.lit(pattern)), found).otherwise(F.array().cast(_NO_SPANS))


def _apart(candidates: Column, base: Column) -> Column:
    """The candidates that overlap no span of ``base``.

    In order of start, a candidate overlaps if a base span at or before its start reaches into
    it, or if the next base span starts in it.
    """

    def of(spans: Column) -> Column:
        is_base = lambda s: s["rank"] < KINDS.index("entropy")
        reach = running(
            F.transform(spans, lambda s: F.when(is_base(s), s["end"]).otherwise(0)), F.greatest
        )
        starts = F.transform(
            F.reverse(spans), lambda s: F.when(is_base(s), s["at"]).otherwise(_FAR)
        )
        together = F.arrays_zip(
            spans.alias("span"),
            reach.alias("reach"),
            F.reverse(running(starts, F.least)).alias("next"),
        )
        free = F.filter(
            together,
            lambda z: ~is_base(z["span"])
            & (z["reach"] <= z["span"]["at"])
            & (z["next"] >= z["span"]["end"]),
        )
        return F.transform(free, lambda z: z["span"])

    several = (F.size(candidates) > 0) & (F.size(base) > 0)
    return F.when(several, let(F.array_sort(F.concat(base, candidates)), of)).otherwise(candidates)


def _weight(count: Column) -> Column:
    """c * log2(c) for a count of up to a window's length."""
    table = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 2)]
    return F.element_at(F.array(*[F.lit(w) for w in table]), count + 1)


# Counts of up to a window's length take five bits; so many of them share a long.
_COUNT_BITS, _SHARED = 5, 12
_WORDS = -(-len(ALPHABET) // _SHARED)


def _shift(direction: str, value: Column, bits: Column) -> Column:
    return F.call_function(f"shift{direction}", value, bits)


def highest_entropy(candidate: Column) -> Column:
    """The most bits a character has in any window of a candidate string.

    The window slides by one character at a time and keeps the count of each symbol, several
    to a number. Its entropy is log2(n) - sum(c * log2(c)) / n, of which only the terms of the
    symbol that leaves and the one that enters change.
    """

    def at(char: Column) -> Column:
        place = F.instr(F.lit(ALPHABET), char) - 1
        bits = (place % _SHARED) * _COUNT_BITS
        return F.struct(F.floor(place / _SHARED).cast("int").alias("word"), bits.alias("bits"))

    def count(state: Column, symbol: Column) -> Column:
        word = state["w0"]
        for k in range(1, _WORDS):
            word = F.when(symbol["word"] == k, state[f"w{k}"]).otherwise(word)
        return _shift("right", word, symbol["bits"]).bitwiseAND(2**_COUNT_BITS - 1).cast("int")

    def one(symbol: Column, k: int) -> Column:
        unit = _shift("left", F.lit(1).cast("bigint"), symbol["bits"])
        return F.when(symbol["word"] == k, unit).otherwise(F.lit(0).cast("bigint"))

    def step(state: Column, place: Column, symbols: Column) -> Column:
        enters = F.element_at(symbols, place)
        full = place > WINDOW
        leaves = F.element_at(symbols, F.greatest(place - WINDOW, F.lit(1)))
        c_in, c_out = count(state, enters), count(state, leaves)
        lost = F.when(full, _weight(F.greatest(c_out - 1, F.lit(0))) - _weight(c_out)).otherwise(0.0)
        change = F.when(full & (leaves == enters), 0.0).otherwise(
            _weight(c_in + 1) - _weight(c_in) + lost
        )
        total = state["total"] + change
        words = [
            (state[f"w{k}"] + one(enters, k) - F.when(full, one(leaves, k)).otherwise(0)).alias(f"w{k}")
            for k in range(_WORDS)
        ]
        least = F.when(place >= WINDOW, F.least(state["least"], total)).otherwise(state["least"])
        return F.struct(*words, total.alias("total"), least.alias("least"))

    start = F.struct(
        *[F.lit(0).cast("bigint").alias(f"w{k}") for k in range(_WORDS)],
        F.lit(0.0).alias("total"),
        F.lit(WINDOW * math.log2(WINDOW)).alias("least"),
    )
    least = let(
        F.transform(F.split(candidate, ""), at),
        lambda symbols: F.aggregate(
            F.sequence(F.lit(1), F.size(symbols)),
            start,
            lambda state, place: step(state, place, symbols),
            lambda s: s["least"],
        ),
    )
    return F.lit(math.log2(WINDOW)) - least / WINDOW


def _without_recursion(pattern: str) -> str:
    """A repeated group at the end of a pattern, written so that Java's matcher takes each turn
    for good. Nothing that it matches otherwise is lost, as each turn begins with a sign that
    the one before cannot hold; and a text of any length takes no stack."""
    return pattern.replace(")*$", ")*+$")


def _is_random(hit: Column) -> Column:
    allowed = F.lit(False)
    for pattern in ALLOWED:
        allowed = allowed | F.regexp_like(hit, F.lit(_without_recursion(pattern)))
    is_hex = F.regexp_like(hit, F.lit("^([0-9a-f]+|[0-9A-F]+)$"))
    bits = F.when(is_hex, HEX_BITS).otherwise(MIXED_BITS)
    return ~allowed & (highest_entropy(hit) > bits)


def _scanned(docs: DataFrame) -> DataFrame:
    """Each row of ``docs`` as ``row``, with its ``spans``."""
    text = F.coalesce("text", F.lit(""))
    found = docs.select(
        F.struct("*").alias("row"),
        F.concat(
            _spans(text, "assign", ASSIGN, LEAST["assign"], 4),
            _spans(text, "access", ACCESS, LEAST["access"], 2),
            # Runs of hexadecimal digits are maximal, so short ones can be left out at once.
            _spans(text, "hex", rf"[0-9a-f]{{{LEAST['hex']},}}", 1, 2),
        ).alias("base"),
        _spans(text, "entropy", CANDIDATE, 1, 2).alias("candidates"),
    )
    found = found.withColumn("apart", _apart(F.col("candidates"), F.col("base")))
    random = F.filter("apart", lambda c: _is_random(c["hit"]))
    added = F.when(F.size("apart") > 0, random).otherwise(F.col("apart"))
    named = F.transform(
        F.array_sort(F.concat("base", added)),
        lambda s: F.struct(
            F.element_at(F.array(*[F.lit(k) for k in KINDS]), s["rank"] + 1).alias("kind"),
            s["at"].alias("start"),
            s["end"].alias("end"),
        ),
    )
    return found.select("row", named.alias("spans"))


def find_secrets(docs: DataFrame) -> DataFrame:
    """The secrets of each text, as ``doc_id`` and ``spans``.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A span has its
    ``kind``, ``start`` and ``end`` in code points, end exclusive; spans are in order of
    start, then of ``KINDS``. The first three kinds have fixed shapes. The fourth are
    strings of ``WINDOW`` or more characters some window of which has a high entropy for
    its character class, unless they are on the allow-list or overlap a span of the other
    kinds. One row for each input row; a missing or empty text has no spans. A text of
    any length, with any number of spans, is searched as a whole, in a few passes for each kind.
    """
    return _scanned(docs).select("row.doc_id", "spans")


def as_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
        ",",
    )


def _redacted(text: Column, spans: Column, mark: str) -> Column:
    """The text with ``mark`` in place of each span; spans that overlap get one mark.

    The text is taken apart into characters, as to find a place in it means to count from its
    beginning.
    """

    def piece(chars: Column, start: Column, end: Column) -> Column:
        return F.array_join(F.slice(chars, start + 1, F.greatest(end - start, F.lit(0))), "")

    def put_together(z: Column) -> Column:
        kept = F.zip_with(
            z["spans"],
            shifted(z["ends"], 0),
            lambda s, done: F.when(
                s["start"] >= done, F.concat(piece(z["chars"], done, s["start"]), F.lit(mark))
            ).otherwise(""),
        )
        rest = piece(z["chars"], F.get(z["ends"], F.size(z["ends"]) - 1), F.size(z["chars"]))
        return F.concat(F.array_join(kept, ""), rest)

    ends = running(F.transform(spans, lambda s: s["end"]), F.greatest)
    parts = F.struct(F.split(text, "").alias("chars"), spans.alias("spans"), ends.alias("ends"))
    return let(parts, put_together)


def without_secrets(docs: DataFrame, mark: str = "[secret]") -> DataFrame:
    """``docs`` with ``mark`` in place of each secret of ``find_secrets``.

    All rows and columns stay; ``n_chars``, if there, follows the text.
    """
    rows = _scanned(docs)
    text = F.when(F.size("spans") > 0, _redacted(F.col("row.text"), F.col("spans"), mark)).otherwise(
        F.col("row.text")
    )
    rows = rows.withColumn("row", F.col("row").withField("text", text))
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size("spans") > 0, F.length("row.text")).otherwise(F.col("row.n_chars"))
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("row", F.col("row").withField("n_chars", n_chars.cast(kind)))
    return rows.select("row.*")
