"""Scores documents by a subword lattice whose weights are learned from the corpus."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.lattice import Lattice, read_vocabulary
from tillwork.llm.words import words
from tillwork.llm.workspace import Workspace, map_batches
from tillwork.operators.hot import spread

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
# Fewer words than this can each be more than this share of all tokens; their scores are
# sent to every task.
FREQUENT = 1_000_000
# Longer words are never sent to every task, however frequent.
FREQUENT_BYTES = 64
# What each word gives up of its count for the pieces it is made of.
DISCOUNT = 0.75
ROUNDS = 2
# Words that a task scores at a time.
TOGETHER = 65_536


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    """Whether a row is kept from training; a row without an id is."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(True))


def _counted(docs: DataFrame) -> DataFrame:
    """Each word of the corpus with its count in training rows and in all."""

    def make():
        def convert(rows):
            train, all_rows = Counter(), Counter()
            for text, held in zip(rows["text"], rows["held_out"], strict=True):
                (all_rows if held else train).update(words(text, lower=True))
            all_rows.update(train)
            return {
                "word": list(all_rows),
                "n": [train[w] for w in all_rows],
                "total": list(all_rows.values()),
            }

        return convert

    schema = "word binary, n long, total long"
    parts = map_batches(docs.select("text", "held_out"), schema, make)
    return parts.groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def _together(
    df: DataFrame, schema: str, make: Callable[[], tuple[Callable, Callable]]
) -> DataFrame:
    """``mapInArrow`` over some ``TOGETHER`` words at a time.

    ``make`` gives a function from a table of words to a batch, or to None, and a
    function for what is left to say at the end of a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert, finish = make()
        waiting, n = [], 0
        for batch in batches:
            waiting.append(batch)
            n += batch.num_rows
            if n >= TOGETHER:
                yield from filter(None, [convert(pa.Table.from_batches(waiting))])
                waiting, n = [], 0
        if waiting:
            yield from filter(None, [convert(pa.Table.from_batches(waiting))])
        yield from filter(None, [finish()])

    return df.mapInArrow(run, schema)


def _expected(vocab: DataFrame, pieces: list[bytes], weights: np.ndarray) -> np.ndarray:
    """How often each piece is used if every word of the training rows is spelled once."""

    def make():
        lattice, counts = Lattice(pieces), np.zeros(len(pieces))

        def convert(table):
            nonlocal counts
            counts += lattice.expected(table.column("word").to_pylist(), weights)

        def finish():
            used = np.flatnonzero(counts)
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array(counts[used])], ["piece", "uses"]
            )

        return convert, finish

    # One row for each piece of the vocabulary file, whatever the size of the corpus.
    uses = _together(vocab.filter("n > 0").select("word"), "piece int, uses double", make)
    rows = uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect()
    counts = np.zeros(len(pieces))
    counts[[r["piece"] for r in rows]] = [r["uses"] for r in rows]
    return counts


def _logs(weights: np.ndarray, opens: np.ndarray, stop: float) -> np.ndarray:
    """Log probabilities of the pieces: of those that open a word to do so, of the others
    to follow any piece, where the word may also stop."""
    first = weights / weights[opens].sum()
    later = weights / weights[~opens].sum() * (1 - stop)
    return np.log(np.where(opens, first, later))


def _scored(
    vocab: DataFrame, pieces: list[bytes], logs: np.ndarray, spelled_at_all: float, events: float
) -> DataFrame:
    """The log10 probability of each word: as a whole, or spelled in any way."""

    def make():
        lattice = Lattice(pieces)

        def convert(table):
            spelled = lattice.log_weights(table.column("word").to_pylist(), logs) + spelled_at_all
            n = table.column("n").to_numpy()
            whole = np.maximum(n - DISCOUNT, 0.0) / events
            with np.errstate(divide="ignore"):
                score = np.logaddexp(spelled, np.log(whole)) / math.log(10)
            return pa.RecordBatch.from_arrays(
                [table.column(c).combine_chunks() for c in ("word", "n", "total")]
                + [pa.array(score)],
                ["word", "n", "total", "score"],
            )

        return convert, lambda: None

    schema = "word binary, n long, total long, score double"
    return _together(vocab.select("word", "n", "total"), schema, make)


def _read(docs: DataFrame, known: dict[bytes, tuple[float, float, int]]) -> DataFrame:
    """Each row's sums over the frequent words, and its other words with their counts."""

    def make():
        def convert(rows):
            out = {n: [] for n in ("n_tokens", "base", "score", "n_known", "rest")}
            for text in rows["text"]:
                counts = Counter(words(text, lower=True))
                base, score, seen, rest = [], [], 0, []
                for word, n in counts.items():
                    if (values := known.get(word)) is None:
                        rest.append({"word": word, "times": n})
                    else:
                        base.append(n * values[0])
                        score.append(n * values[1])
                        seen += n * values[2]
                out["n_tokens"].append(sum(counts.values()))
                out["base"].append(math.fsum(base))
                out["score"].append(math.fsum(score))
                out["n_known"].append(seen)
                out["rest"].append(rest)
            return out | {"doc_id": rows["doc_id"], "held_out": rows["held_out"]}

        return convert

    schema = (
        "doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
        "score double, rest array<struct<word:binary,times:long>>"
    )
    return map_batches(docs, schema, make)


def lattice_scores(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """The log10 probability of each whole text under a model learned from the corpus.

    ``docs`` has ``doc_id`` and ``text``; other columns are not read. A-Z are lowered; the
    tokens of a text are its words and one end. Rows with ``held_out`` are scored but not
    learned from.

    The model draws one event after another: a word of the training rows, the end, or a
    word spelled from the pieces of the vocabulary file, a first one and others until it
    stops. A text can come about in many ways; its score sums over all segmentations, by
    a forward recursion in log space over each word's lattice. Words do not share pieces,
    so a text's score is the sum of its words' scores. The file's scores weigh the pieces
    at first; expected uses over the training words, each spelled once, replace them,
    ``ROUNDS`` times. Every word gives up ``DISCOUNT`` of its count for spelled ones, and
    single bytes are pieces, so no text has probability 0.

    Returns one row for each input row: ``doc_id, held_out, n_tokens, n_known`` (tokens met
    in training), ``train_tokens``, ``base_score`` (of single tokens, one added to each
    count) and ``score``. A missing or empty text is its end alone. A row without an id is
    held out. Rows are scored one by one, also where they share an id.

    All training rows count. Scores of very frequent words, of which there are fewer than
    ``FREQUENT``, are sent to every task; the others meet their rows in a join, which no
    single word can make uneven.
    """
    work = Workspace(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).withColumn(
        "held_out", held_out(F.col("doc_id"))
    )
    vocab = work.put(_counted(docs))
    sums = vocab.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum("total")).first()
    ends = docs.filter(~F.col("held_out")).count()
    tokens = (sums[0] or 0) + ends
    types = sums[1] + (ends > 0)

    pieces, weights = read_vocabulary(vocabulary)
    opens = np.array([p[:1] == b" " for p in pieces])
    stop = 0.25
    for _ in range(ROUNDS):
        uses = _expected(vocab, pieces, _logs(weights, opens, stop)) + 0.1
        weights, stop = uses, uses[opens].sum() / uses.sum()
    # Of all events, one and what the words gave up are spelled words.
    events = tokens + 1
    spelled = (DISCOUNT * sums[1] + 1) / events
    end_score = math.log10(max(ends, 0.5) / events)

    below = math.log10(tokens + types + 1)

    def base(n: Column) -> Column:
        return F.log10(n + 1) - F.lit(below)

    logs = _logs(weights, opens, stop)
    scored = work.put(_scored(vocab, pieces, logs, math.log(spelled * stop), events))
    frequent = (F.col("total") * FREQUENT > (sums[2] or 0)) & (F.length("word") <= FREQUENT_BYTES)
    known = {
        bytes(r["word"]): (r["base"], r["score"], int(r["n"] > 0))
        for r in scored.filter(frequent).select("word", base(F.col("n")).alias("base"), "score", "n").collect()
    }
    read = work.put(_read(docs, known).withColumn("row", F.monotonically_increasing_id()))
    rest = (
        read.select("row", F.explode("rest").alias("r"))
        .select("row", "r.word", "r.times")
        .join(scored.filter(~frequent).select("word", "n", "score"), "word")
        .groupBy("row", spread("row"))
        .agg(
            F.sum(F.col("times") * base(F.col("n"))).alias("rest_base"),
            F.sum(F.col("times") * F.col("score")).alias("rest_score"),
            F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("rest_known"),
        )
    )
    zero = F.lit(0.0)
    end_base = math.log10(ends + 1) - below
    return read.join(rest, "row", "left").select(
        "doc_id",
        "held_out",
        (F.col("n_tokens") + 1).alias("n_tokens"),
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest_base", zero) + end_base).alias("base_score"),
        (F.col("score") + F.coalesce("rest_score", zero) + end_score).alias("score"),
    )
