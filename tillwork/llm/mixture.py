"""Mixes sources to target sizes by hash thresholds, with DataFrame functions only.

Each row has a hash of its own; a source takes the rows whose hash lies below one
threshold. The threshold is found from histograms: sizes are summed by the leading bits
of the hash, the bucket in which the budget ends is cut by further bits, and so on until
it holds one row. Nothing is sorted but a source's few thousand buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwork.llm.words import WORD
from tillwork.llm.workspace import Workspace

HASH_BITS = 60
LEVEL_BITS = 12


def _draw() -> Column:
    """60 bits that depend on a row's id and text alone."""
    own = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    text = F.coalesce("text", F.lit(""))
    return F.conv(F.substring(F.md5(F.concat(own, text)), 1, 15), 16, 10).cast("long")


def _targets(sized: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Size and target of each source.

    A source is held at ``most`` times its size if the budget would still fill it there
    when all others get the same amount for each unit of weight.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place - 1) % len(weights) + 1)
    limit = most * F.col("source_size")
    sources = sizes.select("source", "source_size", weight.alias("weight"), limit.alias("limit"))
    fills_at = F.col("limit") / F.col("weight")
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = Window.orderBy("fills_at").rangeBetween(Window.unboundedPreceding, 0)
    budget = F.lit(share) * F.sum("source_size").over(everything)
    other_weight = F.sum("weight").over(everything) - F.sum("weight").over(so_far)
    sources = (
        sources.withColumn("fills_at", fills_at)
        .withColumn("budget", budget)
        .withColumn(
            "held", F.sum("limit").over(so_far) + F.col("fills_at") * other_weight <= F.col("budget")
        )
    )
    left = F.col("budget") - F.sum(F.when(F.col("held"), F.col("limit"))).over(everything)
    left = F.coalesce(left, F.col("budget"))
    free = F.sum(F.when(~F.col("held"), F.col("weight"))).over(everything)
    target = F.when(F.col("held"), F.col("limit").cast("double")).otherwise(
        left * F.col("weight") / free
    )
    return sources.select("source", "source_size", target.alias("target"))


def thresholds(
    sized: DataFrame,
    work: Workspace,
    weights: tuple[int, ...],
    share: float,
    most: int,
) -> DataFrame:
    """For each source its size and target, how often all its rows are taken, and ``below``:
    rows with a smaller hash are taken once more."""
    targets = _targets(sized, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
    whole = F.coalesce(whole, F.lit(0)).cast("int")
    targets = work.put(
        targets.withColumn("whole", whole).withColumn(
            "need", F.col("target") - F.col("whole") * F.col("source_size")
        )
    )
    # An open bucket is where a source's budget ends: it begins at ``first``, the rows
    # below it have the size ``before``, those in it ``inside``, ``n`` of them any size.
    start = targets.select(F.col("source").alias("of"), "need", F.lit(0).alias("before"))
    rows, done = sized, None
    for shift in range(HASH_BITS - LEVEL_BITS, -1, -LEVEL_BITS):
        histogram = rows.groupBy("source", F.shiftright("draw", shift).alias("bucket")).agg(
            F.sum("size").alias("inside"), F.count_if(F.col("size") > 0).alias("n")
        )
        running = F.sum("inside").over(Window.partitionBy("source").orderBy("bucket"))
        edge = work.put(
            histogram.withColumn("running", running)
            .join(start.select("of", "need", "before"), F.col("source").eqNullSafe(F.col("of")))
            .withColumn("until", F.col("before") + F.col("running"))
            .filter("until > need")
            .groupBy("of", "need")
            .agg(F.min(F.struct("bucket", "until", "inside", "n")).alias("b"))
            .select(
                "of",
                "need",
                F.shiftleft("b.bucket", shift).alias("first"),
                (F.col("b.until") - F.col("b.inside")).alias("before"),
                F.col("b.inside").alias("inside"),
                F.col("b.n").alias("n"),
                F.lit(2**shift).cast("long").alias("width"),
            )
        )
        settled = edge.filter("n = 1") if shift else edge
        done = settled if done is None else done.unionByName(settled)
        start = edge.filter("n > 1")
        if not shift or start.isEmpty():
            break
        cut = start.select("of", F.shiftright("first", shift).alias("cut"))
        here = F.col("source").eqNullSafe(F.col("of")) & (F.shiftright("draw", shift) == F.col("cut"))
        rows = sized.join(cut, here).select("source", "draw", "size")
    # The last bucket is taken if that comes closer to the target.
    closer = F.col("before") + F.col("inside") - F.col("need") < F.col("need") - F.col("before")
    below = done.select("of", (F.col("first") + F.when(closer, F.col("width")).otherwise(0)).alias("below"))
    plan = targets.join(below, F.col("source").eqNullSafe(F.col("of")), "left").select(
        F.col("source").alias("of"),
        "source_size",
        "target",
        "whole",
        F.coalesce("below", F.lit(0)).alias("below"),
    )
    # As a table its size is known, so that Spark can tell whether to broadcast it.
    return work.put(plan)


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        _draw().alias("draw"),
    )


def mixture(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """How many words of each row the mix takes.

    ``docs`` has ``doc_id``, ``text`` and ``source``; other columns are not read. A row's
    size is its number of words. Sources in code-point order, null last, weigh
    ``weights``, repeating, and share ``share`` times all words by weight; a target stops
    at ``most`` times the source's size, and the others share what is left over. Returns
    one row for each input row: ``doc_id, size, source_size, target`` (of its source) and
    ``taken``, the row's size times the number of times it is taken.

    Rows are taken whole, so a source's taken words differ from its target by at most
    half the row at the threshold. Rows with the same id and text have the same hash and
    are taken alike. A missing text has no words. Null is a source like any other.
    """
    work = Workspace(docs.sparkSession)
    sized = work.put(_sized(docs))
    plan = thresholds(sized, work, weights, share, most)
    taken = F.col("size") * (F.col("whole") + F.when(F.col("draw") < F.col("below"), 1).otherwise(0))
    return sized.join(plan, F.col("source").eqNullSafe(F.col("of"))).select(
        "doc_id", "size", "source_size", "target", taken.alias("taken")
    )


def mixed_documents(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2
) -> DataFrame:
    """The rows of the mix, with all columns of ``docs``; a row taken twice is there twice.

    The choice is that of ``mixture``. A row without words is there once if its source's
    rows are taken at least once.
    """
    work = Workspace(docs.sparkSession)
    plan = thresholds(work.put(_sized(docs)), work, weights, share, most)
    rows = docs.select(F.struct("*").alias("row"), F.col("source").alias("its"), _draw().alias("draw"))
    times = F.col("whole") + F.when(F.col("draw") < F.col("below"), 1).otherwise(0)
    return (
        rows.join(plan, F.col("its").eqNullSafe(F.col("of")))
        .select("row", F.explode(F.array_repeat(F.lit(1), times)))
        .select("row.*")
    )
