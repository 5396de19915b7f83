"""Passages that repeat across documents, by level-wise doubling.

Windows of half the length are looked for first, at few positions: of any run of
``window`` words, the least hashes pick the same half windows in every document that
has the run. Only picked halves that occur in several documents are extended to twice
their length, and only documents that have one are read again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.words import Rolling, WordHashes, minimizers, signed, words
from tillwork.llm.workspace import Workspace, lists, map_batches
from tillwork.operators.hot import spread


def _identity(tokens: list[bytes]) -> tuple[int, int]:
    """128 bits of a word sequence, as two signed longs."""
    digest = xxhash.xxh3_128_digest(b" ".join(tokens))
    return tuple(np.frombuffer(digest, np.int64).tolist())


def _anchored(docs: DataFrame, half: int, window: int) -> DataFrame:
    """Each row's id, identity and number of words, and the hashes of its picked halves."""

    def make():
        hashes, rolling = WordHashes(), Rolling(half)

        def convert(rows):
            keys, counts, picked = [], [], []
            for text in rows["text"]:
                tokens = words(text)
                keys.append(_identity(tokens))
                counts.append(len(tokens))
                halves = rolling.windows(hashes.of(tokens), half)
                at = minimizers(halves, window - half + 1)
                picked.append(signed(np.unique(halves[at])))
            return {
                "doc_id": rows["doc_id"],
                "x": rows["x"],
                "k1": [k[0] for k in keys],
                "k2": [k[1] for k in keys],
                "n_words": counts,
                "picked": lists(picked, pa.int64()),
            }

        return convert

    schema = "doc_id long, x long, k1 long, k2 long, n_words long, picked array<long>"
    return map_batches(docs, schema, make)


def _windows(texts: DataFrame, half: int, window: int) -> DataFrame:
    """The windows that hold a half in ``repeated``, hashed to 128 bits, with their starts."""

    def make():
        hashes, narrow, first, second = WordHashes(), Rolling(half), Rolling(101), Rolling(202)

        def convert(rows):
            out = {n: [] for n in ("h1", "h2", "doc_id", "k1", "k2")}
            starts = []
            for doc_id, k1, k2, text, repeated in zip(
                rows["doc_id"], rows["k1"], rows["k2"], rows["text"], rows["repeated"], strict=True
            ):
                tokens = words(text)
                if _identity(tokens) != (k1, k2):
                    continue  # another text under the same id
                of_words = hashes.of(tokens)
                halves = signed(narrow.windows(of_words, half))
                at = np.flatnonzero(np.isin(halves, np.array(repeated, np.int64)))
                n = len(tokens) - window + 1
                # A start is taken if a repeated half begins at it or up to window - half later.
                change = np.zeros(len(tokens) + 2, np.int64)
                np.add.at(change, np.maximum(at - (window - half), 0), 1)
                np.add.at(change, at + 1, -1)
                taken = np.flatnonzero(np.cumsum(change)[:n] > 0)
                a = signed(first.windows(of_words, window))[taken]
                b = signed(second.windows(of_words, window))[taken]
                order = np.lexsort((taken, b, a))
                a, b, taken = a[order], b[order], taken[order]
                new = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])][: len(a)])
                out["h1"].append(a[new])
                out["h2"].append(b[new])
                starts += np.split(taken, new[1:]) if len(new) else []
                for name, value in (("doc_id", doc_id), ("k1", k1), ("k2", k2)):
                    out[name].append(np.full(len(new), value, np.int64))
            flat = {n: np.concatenate(v) if v else np.empty(0, np.int64) for n, v in out.items()}
            return flat | {"starts": lists(starts, pa.int32())}

        return convert

    schema = "h1 long, h2 long, doc_id long, k1 long, k2 long, starts array<int>"
    return map_batches(texts, schema, make)


def _cut(docs: DataFrame, window: int) -> DataFrame:
    """Texts without the words that the windows from ``marks`` cover."""

    def make():
        def convert(rows):
            kept, counts, removed = [], [], []
            for text, marks in zip(rows["text"], rows["marks"], strict=True):
                tokens = words(text)
                counts.append(len(tokens))
                if marks:
                    own = _identity(tokens)
                    starts = [m["starts"] for m in marks if (m["k1"], m["k2"]) == own]
                    whole = any(s is None for s in starts)
                    at = np.array([p for s in starts for part in s or () for p in part], np.int64)
                    change = np.zeros(len(tokens) + 1, np.int64)
                    np.add.at(change, at, 1)
                    np.add.at(change, at + window, -1)
                    gone = np.cumsum(change)[:-1] > 0
                    if whole:
                        gone[:] = True
                    tokens = [t for t, g in zip(tokens, gone.tolist(), strict=True) if not g]
                removed.append(counts[-1] - len(tokens))
                kept.append(b" ".join(tokens).decode("utf-8"))
            return {
                "doc_id": rows["doc_id"],
                "n_words": counts,
                "n_removed": removed,
                "kept_text": kept,
            }

        return convert

    return map_batches(docs, "doc_id long, n_words long, n_removed long, kept_text string", make)


def remove_repeats(docs: DataFrame, window: int = 50) -> DataFrame:
    """Each document's text without the words of passages that stand in an earlier one.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A window is
    ``window`` consecutive words of one row. A word goes if a window over it also starts
    in a document with a smaller ``doc_id``; all windows are judged on the input.
    Returns ``doc_id, n_words, n_removed, kept_text``, one row for each input row; what
    is left is joined by single spaces.

    A missing or empty text has no words. A row without an id is returned whole and
    never makes others shorter. Rows that repeat an id do not count against each other;
    different texts under one id are judged one by one. Any number of rows may share a
    passage or a whole text.
    """
    if window < 2:
        raise ValueError("a window has two words or more")
    half = window // 2
    work = Workspace(docs.sparkSession)
    # A text is found again by its id and hash: an id may have many.
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("x")
    )
    named = docs.filter(F.col("doc_id").isNotNull())

    rows = work.put(_anchored(named, half, window).filter(F.col("n_words") >= window))
    # Copies of one word sequence are looked at once, under the smallest id.
    texts = work.put(
        rows.groupBy("k1", "k2").agg(
            F.min(F.struct("doc_id", "x")).alias("of"), F.first("picked").alias("picked")
        ).select("k1", "k2", "of.doc_id", "of.x", "picked")
    )
    halves = texts.select("doc_id", "x", "k1", "k2", F.explode("picked").alias("half"))
    shared = (
        halves.groupBy("half", spread("half"))
        .agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
        .filter("least < most")
        .select("half")
    )
    extended = (
        halves.join(shared, "half")
        .groupBy("doc_id", "x", "k1", "k2")
        .agg(F.collect_list("half").alias("repeated"))
    )
    # Rows that repeat both id and text are read once.
    again = not rows.groupBy("doc_id", "x").count().filter("count > 1").isEmpty()
    once = named.groupBy("doc_id", "x").agg(F.first("text").alias("text")) if again else named
    found = work.put(
        once.join(work.put(extended), ["doc_id", "x"]).select("doc_id", "k1", "k2", "text", "repeated")
    )
    windows = work.put(_windows(found, half, window))
    work.drop(found)
    first = (
        windows.groupBy("h1", "h2", spread("h1", "h2"))
        .agg(F.min("doc_id").alias("least"))
        .select("h1", "h2", "least")
    )
    repeated = (
        windows.join(first, ["h1", "h2"])
        .filter("least < doc_id")
        .groupBy("doc_id", "k1", "k2")
        .agg(F.collect_set("starts").alias("starts"))
    )
    # Of a whole copy, every word goes: each lies in some window of the first.
    copies = (
        rows.select("k1", "k2", F.col("doc_id").alias("of"))
        .distinct()
        .join(texts.select("k1", "k2", "doc_id", spread("k1", "k2")), ["k1", "k2"])
        .filter("doc_id < of")
        .select(
            F.col("of").alias("doc_id"),
            "k1",
            "k2",
            F.lit(None).cast("array<array<int>>").alias("starts"),
        )
    )
    same = rows.select("doc_id", "x", "k1", "k2").distinct()
    marks = (
        repeated.unionByName(copies)
        .join(same, ["doc_id", "k1", "k2"])
        .groupBy("doc_id", "x")
        .agg(F.collect_list(F.struct("k1", "k2", "starts")).alias("marks"))
    )
    marked = named.join(work.put(marks), ["doc_id", "x"], "left")
    unnamed = docs.filter(F.col("doc_id").isNull()).withColumn(
        "marks", F.lit(None).cast(marks.schema["marks"].dataType)
    )
    return _cut(marked.unionByName(unnamed).select("doc_id", "text", "marks"), window)
