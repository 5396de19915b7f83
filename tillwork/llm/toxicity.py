"""Toxicity of documents by a factorization machine over hashed terms."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwork.llm.workspace import Workspace, lists, map_batches

# Terms are hashed to so many bits.
BITS = 20
# A term is a whole word, or how a word begins.
BEGINNINGS = (3, 4, 5, 6)
# About so many labelled rows of each class are learned from; see ``fit``.
SAMPLE = 10_000
# Terms take part if the likelihood ratio says this much for a tie to the class (twice
# the log, so chi-square with one degree of freedom without one).
LEAST_G = 12.0
FACTORS = 4
# Passes over the sample, and the least number of batches in all.
EPOCHS = 4
BATCHES = 600
BATCH = 64
DECAY = 1e-2
_CACHED_WORDS = 500_000


class Terms(dict):
    """The hashed terms of words. It keeps a bounded number of them."""

    find = staticmethod(re.compile(r"[^\W_]+").findall)

    def __init__(self, known: np.ndarray | None = None):
        self.places = None if known is None else {int(t): i for i, t in enumerate(known)}

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        parts = ["w" + word] + ["b" + word[:n] for n in BEGINNINGS if len(word) > n]
        terms = [xxhash.xxh32_intdigest(p) & ((1 << BITS) - 1) for p in parts]
        if self.places is not None:
            terms = [self.places[t] for t in terms if t in self.places]
        self[word] = terms
        return terms

    def of(self, text: str | None) -> np.ndarray:
        """The distinct terms of a whole text, or their places among the known ones."""
        found: set[int] = set()
        for word in set(self.find((text or "").lower())):
            found.update(self[word])
        return np.fromiter(sorted(found), np.int64, len(found))


@dataclass
class Model:
    """log odds = bias + sum(linear) + sum over pairs of terms of the product of factors."""

    terms: np.ndarray
    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def odds(self, places: np.ndarray) -> float:
        own = self.factors[places]
        pairs = own.sum(axis=0) ** 2 - (own**2).sum(axis=0)
        return self.bias + self.linear[places].sum() + 0.5 * pairs.sum()

    def score(self, places: np.ndarray) -> float:
        odds = self.odds(places)
        return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def learn(rows: list[np.ndarray], labels: np.ndarray, terms: np.ndarray, seed: int = 1) -> Model:
    """Fits the machine by AdaGrad on the log loss, both classes weighing the same."""
    toxic = labels.mean() if len(labels) else 0.0
    n = len(terms)
    if not 0 < toxic < 1:
        # Nothing to tell apart: the share of toxic rows, 0 if there are none.
        share = labels.sum() / (len(labels) + 1)
        bias = math.log(share / (1 - share)) if share else -math.inf
        return Model(terms, bias, np.zeros(n), np.zeros((n, FACTORS)))
    draw = np.random.default_rng(seed)
    model = Model(terms, 0.0, np.zeros(n), draw.normal(0, 0.01, (n, FACTORS)))
    weight = np.where(labels == 1, 0.5 / toxic, 0.5 / (1 - toxic))
    seen_linear, seen_factors = np.full(n, 1e-8), np.full((n, FACTORS), 1e-8)
    seen_bias = 1e-8
    for _ in range(max(EPOCHS, math.ceil(BATCHES * BATCH / len(rows)))):
        order = draw.permutation(len(rows))
        for start in range(0, len(order), BATCH):
            batch = order[start : start + BATCH]
            sizes = np.array([len(rows[i]) for i in batch])
            # A last term of weight 0 stands in for rows without terms.
            at = np.concatenate([np.r_[rows[i], n] for i in batch])
            of = np.repeat(np.arange(len(batch)), sizes + 1)
            begins = np.r_[0, np.cumsum(sizes + 1)[:-1]]
            own = np.vstack([model.factors, np.zeros(FACTORS)])[at]
            total = np.add.reduceat(own, begins)
            odds = (
                model.bias
                + np.add.reduceat(np.r_[model.linear, 0.0][at], begins)
                + 0.5 * (total**2 - np.add.reduceat(own**2, begins)).sum(axis=1)
            )
            slope = (1 / (1 + np.exp(-np.clip(odds, -50, 50))) - labels[batch]) * weight[batch]
            real = at < n
            used, back = np.unique(at[real], return_inverse=True)
            pull, of, own = slope[of[real]], of[real], own[real]
            if len(used):
                step = np.bincount(back, pull, len(used)) + DECAY * model.linear[used]
                seen_linear[used] += step**2
                model.linear[used] -= 0.1 * step / np.sqrt(seen_linear[used])
                grow = pull[:, None] * (total[of] - own)
                step = np.stack([np.bincount(back, g, len(used)) for g in grow.T], axis=1)
                step += 1e-3 * model.factors[used]
                seen_factors[used] += step**2
                model.factors[used] -= 0.03 * step / np.sqrt(seen_factors[used])
            seen_bias += slope.sum() ** 2
            model.bias -= 0.1 * slope.sum() / math.sqrt(seen_bias)
    return model


def held_out(doc_id: Column, folds: int = 5, fold: int = 0) -> Column:
    """Whether a row's label is kept from learning; that of a row without an id is."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % folds
    return F.coalesce(remainder == fold, F.lit(True))


def _term_rows(docs: DataFrame, known: np.ndarray | None = None) -> DataFrame:
    """The distinct terms of each labelled text."""

    def make():
        terms = Terms(known)

        def convert(rows):
            found = [terms.of(text) for text in rows["text"]]
            return {"toxic": rows["toxic"], "terms": lists(found, pa.int32())}

        return convert

    return map_batches(docs.select("toxic", "text"), "toxic int, terms array<int>", make)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns from about ``sample`` labelled ids of each class, or from all if fewer.

    Ids are chosen by their hash, and of an id with several texts the one of least hash, so the
    model depends on the rows alone. Held-out
    ids, null ids and null labels are not learned from; an id with several labels is toxic
    if one says so.
    """
    work = Workspace(docs.sparkSession)
    given = (
        labels.select(F.col("doc_id").cast("long").alias("of"), F.col("toxic").cast("int"))
        .filter("of IS NOT NULL AND toxic IN (0, 1)")
        .filter(~held_out(F.col("of")))
        .groupBy("of")
        .agg(F.max("toxic").alias("toxic"))
    )
    sizes = {r["toxic"]: r["count"] for r in given.groupBy("toxic").count().collect()}
    draw = F.pmod(F.xxhash64("of"), F.lit(2**32)) / float(2**32)
    share = F.when(F.col("toxic") == 1, sample / max(sizes.get(1, 1), 1)).otherwise(
        sample / max(sizes.get(0, 1), 1)
    )
    # Bounded by ``sample``, so small enough for every task.
    chosen = work.put(given.filter(draw < share))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    # One text of each id, so that the sample is bounded by rows, too.
    first = F.min(F.struct(F.xxhash64("text").alias("place"), "text", "toxic")).alias("row")
    examples = texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("of")).groupBy("of")
    rows = work.put(_term_rows(examples.agg(first).select("row.text", "row.toxic")))
    n1, n0 = (rows.filter(F.col("toxic") == c).count() for c in (1, 0))
    with_term = F.col("with1") + F.col("with0")

    def part(n: Column, of_term: Column, of_class: int) -> Column:
        return F.when(n > 0, n * F.log(n * (n1 + n0) / (of_term * of_class))).otherwise(0.0)

    without = n1 + n0 - with_term
    ratio = 2 * (
        part(F.col("with1"), with_term, n1)
        + part(F.col("with0"), with_term, n0)
        + part(n1 - F.col("with1"), without, n1)
        + part(n0 - F.col("with0"), without, n0)
    )
    # One row for each hashed term at most.
    selected = (
        rows.select("toxic", F.explode("terms").alias("term"))
        .groupBy("term")
        .agg(F.sum("toxic").alias("with1"), F.sum(1 - F.col("toxic")).alias("with0"))
        .filter(ratio >= LEAST_G)
        .select("term")
    )
    terms = np.sort(np.array([r["term"] for r in selected.collect()], np.int64))
    return _trained(rows, terms)


def _trained(rows: DataFrame, terms: np.ndarray) -> Model:
    """Learns in one task, which holds the sample with its selected terms; the driver gets
    one row for each of those terms."""
    schema = "term long, linear double, factors array<double>"

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = []
        for batch in batches:
            for toxic, found in zip(
                batch.column("toxic").to_pylist(), batch.column("terms").to_pylist(), strict=True
            ):
                own = np.array(found, np.int64)
                sample.append((toxic, np.searchsorted(terms, own[np.isin(own, terms)]).tolist()))
        # In an order of their own, so that the model does not depend on how rows arrive.
        sample.sort()
        labels = np.array([toxic for toxic, _ in sample], float)
        model = learn([np.array(at, np.int64) for _, at in sample], labels, terms)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.r_[-1, terms], pa.int64()),
                pa.array(np.r_[model.bias, model.linear]),
                lists([np.zeros(FACTORS), *model.factors], pa.float64()),
            ],
            ["term", "linear", "factors"],
        )

    learned = sorted(rows.coalesce(1).mapInArrow(train, schema).collect())
    weights = learned[1:]
    return Model(
        terms,
        learned[0]["linear"],
        np.array([r["linear"] for r in weights]),
        np.array([r["factors"] for r in weights]).reshape(len(weights), FACTORS),
    )


def scorer(model: Model):
    """A column function from a text to its score."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        terms = Terms(model.terms)
        for texts in batches:
            yield pd.Series([model.score(terms.of(t)) for t in texts], dtype=float)

    return score


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """How likely each document is toxic, as ``labels`` marks it.

    ``docs`` has ``doc_id`` and ``text``, ``labels`` has ``doc_id`` and ``toxic``; other
    columns are not read, and a score depends on the text alone. A text's terms are its
    lower-case words and their beginnings, hashed, each counted once. Those that tell the
    classes apart enter a factorization machine: a weight for each, and for each pair the
    product of their factors, so that two terms can mean more together than apart.

    Returns one row for each input row: ``doc_id, held_out, score`` (0 to 1) and
    ``predicted`` (1 from 0.5 on). A missing or empty text has no terms and the score of
    the bias. Without a label of both classes all rows get the share of toxic ones, 0 if
    there is no label.
    """
    model = fit(docs, labels, sample)
    doc_id = F.col("doc_id").cast("long")
    scored = docs.select(
        doc_id.alias("doc_id"),
        held_out(doc_id).alias("held_out"),
        scorer(model)("text").alias("score"),
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` that ``toxicity`` does not predict to be toxic, all columns."""
    return docs.filter(scorer(fit(docs, labels, sample))("text") < 0.5)
