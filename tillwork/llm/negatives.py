"""Hard negatives by exact integer scores: anchors times all rows, block by block.

The anchors are a fixed share of the table. They and all rows are packed into blocks of a
bounded number of rows; each task multiplies one block of anchors with one of rows and
returns a few rows for each anchor, so a hot label or id changes no task's size.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.residues import product
from tillwork.llm.workspace import Workspace, map_batches

# Rows of a block: anchors, and rows they are compared with.
ANCHORS = 1024
ROWS = 4096
# Positives of an anchor, and negatives returned for each.
POSITIVES = 5
NEGATIVES = 5
# A negative's score is at least this many hundredths of the positive's.
LEAST_PERCENT = 80

def _usable(rows: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` and ``vector`` of the rows that take part, each once."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return (
        rows.filter(F.col("vec_id").isNotNull() & label.isNotNull() & vector.isNotNull() & finite)
        .select(F.col("vec_id").cast("long").alias("vec_id"), moved.alias("label"), vector.alias("vector"))
        .distinct()
    )


def quantized(vectors: list[list[float]], width: int) -> np.ndarray:
    """``floor(256 * x)`` as int64, zeros behind shorter vectors.

    A component so large that ``width`` products of two could pass an int64 counts as the
    largest that cannot.
    """
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    most = math.isqrt((2**63 - 1) // max(width, 1))
    with np.errstate(over="ignore"):
        return np.clip(np.floor(256 * out), -most, most).astype(np.int64)


def _whole(table: DataFrame, width: int) -> DataFrame:
    """The rows with their quantized components as int64 bytes."""

    def make():
        def convert(batch):
            vectors = quantized(batch["vector"], width)
            return {n: batch[n] for n in ("row", "vec_id", "label")} | {
                "q": [v.tobytes() for v in vectors]
            }

        return convert

    return map_batches(table, "row long, vec_id long, label long, q binary", make)


def _blocks(rows: DataFrame, name: str, keys: list[Column]) -> DataFrame:
    """Rows packed by ``keys``: one row for each block, the rows in a list ``name``."""
    packed = F.collect_list(F.struct("row", "vec_id", "label", "q"))
    return rows.groupBy(*keys).agg(packed.alias(name))


def _counted(column: Column) -> Column:
    """0, 1 ... ``column`` - 1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), column.cast("long") - 1))


class _Block:
    """The columns of a block, in order of id."""

    def __init__(self, rows: list[dict], width: int):
        rows = sorted(rows, key=lambda r: (r["vec_id"], r["row"]))
        self.row, self.vec_id, self.label = (
            np.array([r[n] for r in rows], np.int64) for n in ("row", "vec_id", "label")
        )
        flat = np.frombuffer(b"".join(r["q"] for r in rows), np.int64)
        self.matrix = flat.reshape(len(rows), width)


def _firsts(at: np.ndarray, score: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores of each anchor ``at``, ties in the order given."""
    order = np.lexsort((-score, at))
    sorted_at = at[order]
    rank = np.arange(len(order)) - np.searchsorted(sorted_at, sorted_at)
    return order[rank < n]


def _positives(pairs: DataFrame, width: int, n: int) -> DataFrame:
    """The ``n`` best rows of the anchor's label in each pair of blocks."""

    def make():
        def convert(batch):
            out = {k: [] for k in ("anchor", "positive_id", "positive_row", "positive_score")}
            for anchors, rows in zip(batch["anchors"], batch["rows"], strict=True):
                a, b = _Block(anchors, width), _Block(rows, width)
                scores = product(a.matrix, b.matrix)
                same = (a.label[:, None] == b.label) & (a.vec_id[:, None] != b.vec_id)
                at, place = np.nonzero(same)
                best = _firsts(at, scores[at, place], n)
                at, place = at[best], place[best]
                out["anchor"].append(a.row[at])
                out["positive_id"].append(b.vec_id[place])
                out["positive_row"].append(b.row[place])
                out["positive_score"].append(scores[at, place])
            return {k: np.concatenate(v) for k, v in out.items()}

        return convert

    schema = "anchor long, positive_id long, positive_row long, positive_score long"
    return map_batches(pairs.select("anchors", "rows"), schema, make)


def _negatives(pairs: DataFrame, width: int, n: int, percent: int) -> DataFrame:
    """The ``n`` best rows of other labels in the window of each positive, in each pair."""

    def make():
        def convert(batch):
            names = ("anchor", "positive_row", "negative_id", "negative_row", "negative_score")
            out = {k: [] for k in names}
            for anchors, goals, rows in zip(
                batch["anchors"], batch["goals"], batch["rows"], strict=True
            ):
                a, b = _Block(anchors, width), _Block(rows, width)
                scores = product(a.matrix, b.matrix)
                of_row = {r: i for i, r in enumerate(a.row.tolist())}
                windows = [
                    (of_row[g["anchor"]], g["positive_score"], _lowest(g["positive_score"], percent), g["positive_row"])
                    for g in goals
                ]
                high = np.full(len(a.row), -(2**63), np.int64)
                low = np.full(len(a.row), 2**63 - 1, np.int64)
                for i, top, bottom, _ in windows:
                    high[i], low[i] = max(high[i], top), min(low[i], bottom)
                inside = (scores <= high[:, None]) & (scores >= low[:, None])
                at, place = np.nonzero(inside & (a.label[:, None] != b.label))
                score = scores[at, place]
                order = np.lexsort((-score, at))
                at, place, score = at[order], place[order], score[order]
                starts = np.searchsorted(at, np.arange(len(a.row) + 1)).tolist()
                for i, top, bottom, row in windows:
                    down = -score[starts[i] : starts[i + 1]]
                    first, last = np.searchsorted(down, -top), np.searchsorted(down, -bottom, "right")
                    taken = slice(starts[i] + first, starts[i] + max(first, min(last, first + n)))
                    k = place[taken]
                    out["anchor"].append(np.full(len(k), a.row[i]))
                    out["positive_row"].append(np.full(len(k), row))
                    out["negative_id"].append(b.vec_id[k])
                    out["negative_row"].append(b.row[k])
                    out["negative_score"].append(score[taken])
            return {k: np.concatenate(v) if v else np.empty(0, np.int64) for k, v in out.items()}

        return convert

    schema = (
        "anchor long, positive_row long, negative_id long, negative_row long, negative_score long"
    )
    return map_batches(pairs.select("anchors", "goals", "rows"), schema, make)


def _lowest(top: int, percent: int) -> int:
    """The least score with ``percent * top <= 100 * score``."""
    return -(-percent * top // 100)


def _best(rows: DataFrame, keys: list[str], score: str, ties: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key, with their ``rank``; Spark cuts before it shuffles."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), *ties)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    percent: int = LEAST_PERCENT,
) -> DataFrame:
    """Rows of other labels that score nearly as high with an anchor as its positives do.

    ``rows`` has ``vec_id``, ``embedding`` and ``label``; other columns are not read. Where
    ``vec_id`` is divisible by 7, the label first becomes ``(label + 1) % 10``. Components
    become ``floor(256 * x)``; a score is the integer inner product with an anchor, a row for
    which ``anchors`` (over ``vec_id``) holds. Higher scores come first, ties by smaller id.
    An anchor's positives are its first ``positives`` other rows of the same label. For each
    of them the first ``negatives`` rows of other labels with ``percent * positive_score <=
    100 * negative_score <= 100 * positive_score`` are returned: ``anchor_id, positive_id,
    rank, negative_id, positive_score, negative_score``; nothing for a positive without any.

    Rows without an id, a label or a vector, or with a component that is null or not finite,
    take no part. Rows equal in all three columns count once; different rows under one id are
    compared one by one, but never with a row of their own id as a positive. A shorter vector
    counts as if zeros followed. Components that could make a score pass a long count as the
    largest that cannot.

    Scores are products modulo primes, put together exactly. Every anchor meets every row,
    those of its own label first; the blocks are dealt by hash, so no label or id fills one.
    """
    work = Workspace(rows.sparkSession)
    usable = work.put(_usable(rows).withColumn("row", F.xxhash64("vec_id", "label", "vector")))
    n, width = usable.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    table = work.put(_whole(usable, width or 0))
    size = max(1, math.ceil(n / ROWS))

    # Labels share groups of about a block; a larger group has several blocks. Each block of
    # its anchors meets each of its rows under a key of their own.
    keyed = table.withColumn("group", F.pmod(F.xxhash64("label"), F.lit(size)))
    sizes = (
        keyed.groupBy("group")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(anchors).alias("m"))
        .select("group", F.ceil(F.col("n") / ROWS).alias("of"), F.ceil(F.col("m") / ANCHORS).alias("by"))
        .filter(F.col("by") > 0)
    )
    keyed = keyed.join(sizes, "group")
    keys = ["group", "part", "side"]
    part, side = F.pmod(F.xxhash64("row"), "of"), F.pmod(F.xxhash64("row"), "by")
    rows_by_label = _blocks(
        keyed.withColumn("side", _counted(F.col("by"))), "rows", [F.col("group"), part.alias("part"), F.col("side")]
    )
    anchors_by_label = _blocks(
        keyed.filter(anchors).withColumn("part", _counted(F.col("of"))),
        "anchors",
        [F.col("group"), F.col("part"), side.alias("side")],
    )
    near = _positives(rows_by_label.join(anchors_by_label, keys), width, positives)
    near = work.put(
        _best(near, ["anchor"], "positive_score", ["positive_id", "positive_row"], positives).drop("rank")
    )

    # Every block of anchors with every block of rows.
    sides = max(1, math.ceil(near.select("anchor").distinct().count() / ANCHORS))
    goals = near.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(sides)).alias("side")).agg(
        F.collect_list(F.struct("anchor", "positive_row", "positive_score")).alias("goals")
    )
    with_goals = (
        _blocks(table.filter(anchors), "anchors", [F.pmod(F.xxhash64("row"), F.lit(sides)).alias("side")])
        .join(goals, "side")
        .withColumn("part", _counted(F.lit(size)))
    )
    all_rows = _blocks(table, "rows", [F.pmod(F.xxhash64("row"), F.lit(size)).alias("part")])
    all_rows = all_rows.withColumn("side", _counted(F.lit(sides)))
    far = _negatives(all_rows.join(with_goals, ["part", "side"]), width, negatives, percent)
    far = _best(
        far, ["anchor", "positive_row"], "negative_score", ["negative_id", "negative_row"], negatives
    )
    ids = table.filter(anchors).select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    return (
        far.join(near, ["anchor", "positive_row"])
        .join(ids, "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
