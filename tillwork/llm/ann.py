"""Nearest neighbours of vectors by learned partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.router import Router, ahead, fit
from tillwork.llm.workspace import Workspace, lists, map_batches

# Vectors that the partitions are learned from, about.
SAMPLE = 8_192
# Most parts; a part of the sample should still hold some tens of vectors.
MOST_PARTS = 256
# Of the nearest in the sample, what routing must find.
RECALL = 0.95
# Vectors, and queries, that are compared in one go.
BLOCK = 16_384
QUERIES = 4_096


def usable(rows: DataFrame) -> DataFrame:
    """Rows that have an id and a vector of finite numbers, not all 0, of the usual length."""
    vector = F.col("embedding").cast("array<double>")
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    finite = F.forall(
        "vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.filter(finite & F.exists("vector", lambda v: v != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).count()
    usual = lengths.agg(F.max_by("length", F.struct("count", "length"))).first()[0]
    return rows.filter(F.size("vector") == (usual or 0))


def _parts(n: int) -> int:
    """A power of two that grows with the root of the number of vectors."""
    return 2 ** max(0, min(int(np.log2(MOST_PARTS)), int(np.log2(max(1.0, n**0.5 / 8)))))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.array(column.combine_chunks().flatten()).reshape(len(column), -1)


def _route(
    rows: DataFrame, router: Router, far: float | None = None, least: np.ndarray | None = None
) -> DataFrame:
    """Adds the part of each vector, or, given ``far``, the parts of each query.

    ``least`` holds the ids in each part over the number of ids that a query should meet.
    """

    def make():
        def convert(columns):
            odds = router.odds(np.array(columns["vector"], float).reshape(len(columns["vec_id"]), -1))
            if far is None:
                parts = [np.array([p]) for p in odds.argmax(axis=1)]
            else:
                order = np.argsort(-odds, axis=1, kind="stable")
                met = np.cumsum(least[order], axis=1) - least[order] < 1
                near = np.take_along_axis(ahead(odds), order, axis=1) < far
                parts = [o[w] for o, w in zip(order, near | met, strict=True)]
            return {**columns, "parts": lists(parts, pa.int32())}

        return convert

    return map_batches(rows, "vec_id long, vector array<double>, parts array<int>", make)


def _nearest(k: int):
    """The ``k`` nearest ids of one block to each of its queries, with exact distances."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(rows: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if len(rows) and len(queries):
            ids, vectors = rows.column("vec_id").to_numpy(), _matrix(rows.column("vector"))
            order = np.argsort(ids, kind="stable")
            ids, vectors = ids[order], vectors[order]
            # Where the rows of each id begin.
            starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            norms = (vectors**2).sum(axis=1)
            for start in range(0, len(queries), 256):
                part = queries.slice(start, 256)
                asked, points = part.column("vec_id").to_numpy(), _matrix(part.column("vector"))
                about = norms[None, :] - 2 * points @ vectors.T + (points**2).sum(axis=1)[:, None]
                for own, point, row in zip(asked, points, about, strict=True):
                    row[ids == own] = np.inf
                    # Copies of an id must not take the places of others.
                    least = row if len(starts) == len(ids) else np.minimum.reduceat(row, starts)
                    last = np.partition(least, min(k, len(least)) - 1)[min(k, len(least)) - 1]
                    # Rounding must not decide which of those about as near are kept.
                    slack = 1e-9 * (abs(last) + point @ point) if np.isfinite(last) else 0.0
                    near = np.flatnonzero((row <= last + slack) & (ids != own))
                    score = np.sqrt(((vectors[near] - point) ** 2).sum(axis=1))
                    order = np.lexsort((ids[near], score))
                    _, first = np.unique(ids[near][order], return_index=True)
                    order = order[np.sort(first)][:k]
                    out.append((np.full(len(order), own), ids[near][order], score[order]))
        columns = zip(*out, strict=True) if out else ([np.empty(0, np.int64)],) * 2 + ([np.empty(0)],)
        return pa.Table.from_arrays(
            [pa.array(np.concatenate(c), f.type) for c, f in zip(columns, schema, strict=True)],
            schema=schema,
        )

    return search


def nearest(rows: DataFrame, is_query, k: int = 10, sample: int = SAMPLE) -> DataFrame:
    """The ``k`` nearest other rows of each query: ``query_id, rank, vec_id, score``.

    ``rows`` has ``vec_id`` and ``embedding``; other columns are not read. ``is_query`` is a
    condition on ``vec_id``. Nearness is Euclidean, in double precision, on the vectors as
    they are; ties go to the smaller id.

    A neighbour graph of about ``sample`` vectors is cut into balanced parts, and a small
    network learns in which parts a vector's neighbours lie. Every row is put into its most
    probable part; a query goes to its most probable parts, as many as are needed to find
    ``RECALL`` of the nearest of sample vectors that were kept out, and ``k`` others. Within a part all rows
    are compared. Parts are cut into blocks of about ``BLOCK`` rows and ``QUERIES`` queries,
    so a part of any size, a vector that many ids have, or an id that has many vectors, is
    shared out. Rows that repeat both id and vector are merged first.

    Rows with a missing id, or a vector that is missing, zero, of another length than most
    or that holds a null or a number that is not finite, take no part. With fewer than
    ``k`` other rows all found are returned. Rows that repeat an id count once, by the nearest.
    """
    work = Workspace(rows.sparkSession)
    rows = usable(rows)
    n, ids = rows.agg(F.count(F.lit(1)), F.count_distinct("vec_id")).first()
    if ids < n:
        # Equal rows meet before the shuffle, however many there are.
        rows = work.put(rows.distinct())
        n = rows.count()
    # By id and vector, here and in blocks: an id may have any number of vectors.
    draw = F.pmod(F.xxhash64("vec_id", "vector", F.lit(1)), F.lit(2**32)) / float(2**32)
    # Bounded by ``sample``, whatever the number of rows; copies of a vector count once.
    chosen = rows.filter(draw < sample / max(n, 1)).select("vector").distinct().orderBy("vector")
    vectors = np.array([r["vector"] for r in chosen.collect()], float)
    router, far = fit(vectors, _parts(n), RECALL, k) if len(vectors) else (Router(np.zeros((1, 1)), 1), 2.0)
    if n and not len(vectors):
        router = Router(np.zeros((1, len(rows.first()["vector"]))), 1)

    index = work.put(
        _route(rows, router).select("vec_id", "vector", F.element_at("parts", 1).alias("part"))
    )
    # One row for each part. An id that is in several counts in one, so that the parts of a
    # query hold at least as many ids as their counts say.
    sizes = np.zeros(router.weights[3].shape)
    held = index if ids == n else index.groupBy("vec_id").agg(F.min("part").alias("part"))
    for row in held.groupBy("part").count().collect():
        sizes[row["part"]] = row["count"]
    queries = work.put(
        _route(rows.filter(is_query), router, far, sizes / (k + 1)).select(
            "vec_id", "vector", F.explode("parts").alias("part")
        )
    )
    blocks = (
        index.groupBy("part")
        .agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("of_rows"))
        .join(
            queries.groupBy("part").agg(
                F.ceil(F.count(F.lit(1)) / QUERIES).cast("int").alias("of_queries")
            ),
            "part",
        )
    )
    blocks = F.broadcast(work.put(blocks))

    def block(number: str):
        return F.pmod(F.xxhash64("vec_id", "vector"), F.col(number)).cast("int")

    def each(number: str):
        return F.explode(F.sequence(F.lit(0), F.col(number) - 1))

    left = index.join(blocks, "part").select(
        "part", block("of_rows").alias("a"), each("of_queries").alias("b"), "vec_id", "vector"
    )
    right = queries.join(blocks, "part").select(
        "part", each("of_rows").alias("a"), block("of_queries").alias("b"), "vec_id", "vector"
    )
    keys = ["part", "a", "b"]
    search = _nearest(k)

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        return search(one, other)

    found = (
        left.groupBy(*keys)
        .cogroup(right.groupBy(*keys))
        .applyInArrow(run, "query_id long, vec_id long, score double")
    )
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
