"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwork.llm.workspace import Workspace
from tillwork.operators.hot import spread


def _least(links: DataFrame) -> DataFrame:
    """The least neighbour of each ``u``, shuffled once more so that hubs can be split."""
    return links.groupBy("u", spread("u")).agg(F.min("v").alias("least")).select("u", "least")


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each node's larger neighbours to the least of its neighbours and itself.

    A link may come out several times; the small-star step counts it once.
    """
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (
        both.join(_least(both), "u")
        .filter("v > u")
        .select(F.col("v").alias("u"), F.least("u", "least").alias("v"))
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the least of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = _least(down)
    moved = down.join(least, "u").filter("v > least").select(F.col("v").alias("u"), F.col("least"))
    return moved.unionByName(least).select("u", F.col("least").alias("v")).distinct()


# Links that one task handles at once; a task for each partition of so few costs more.
FEW = 100_000


def _put(edges: DataFrame, work: Workspace) -> tuple[DataFrame, dict]:
    """The stored links, and what tells them from others."""
    return work.put_observed(
        edges, n=F.count(F.lit(1)), links=F.bit_xor(F.xxhash64("u", "v")), least=F.min("u")
    )


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """Every node of the links ``u, v`` with the least node it can reach: ``node, component``.

    The least node of a component is left out, as are nodes without links. Links of a
    node with itself are ignored. The steps alternate until neither changes a link; the
    number of rounds grows with the logarithm of the number of nodes. Up to ``FEW`` links stay
    in one partition, so that a step takes one task and no shuffle.
    """
    edges, state = _put(edges.select("u", "v").filter("u <> v").distinct(), work)
    while state["n"]:
        old, before = edges, state
        few = edges.coalesce(1) if state["n"] <= FEW else edges
        edges, state = _put(_small_star(_large_star(few)), work)
        work.drop(old)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
