"""Whether the ids of many rows are among those of another table, without shuffling the rows.

Whole-number ids that lie close together fit a bit each: 512 of them are one row of eight
numbers, so the ids of a few hundred million rows make a table that every task can hold. Ids
that lie apart do not gain by it; the size is looked at, and beyond it the rows are joined.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tillwork.operators.hot import spread
from tillwork.session import shared_folder

# Rows of 512 ids that may be sent to every task: 36 MB of numbers at most.
MOST_ROWS = 500_000
_WORDS, _BITS = 8, 64


def _bit(value: Column) -> Column:
    return F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), F.pmod(value, F.lit(_BITS)).cast("int")
    )


def _word(value: Column) -> Column:
    return F.pmod(F.shiftright(value, 6), F.lit(_WORDS))


def id_bits(parents: DataFrame, key: str) -> DataFrame:
    """The ids of ``parents``: ``_block`` for each 512, and a bit for each in ``_w0`` ... ``_w7``."""
    ids = F.col("_id")
    known = parents.select(F.col(key).cast("bigint").alias("_id")).filter(ids.isNotNull())
    nothing = F.lit(0).cast("bigint")
    words = [
        F.bit_or(F.when(_word(ids) == n, _bit(ids)).otherwise(nothing)).alias(f"_w{n}")
        for n in range(_WORDS)
    ]
    return known.groupBy(F.shiftright(ids, 9).alias("_block")).agg(*words)


def _ids_in(w: int) -> Column:
    """The ids that a row of bits has in one of its words."""
    first = F.shiftleft("_block", 9) + w * _BITS
    bits = F.sequence(F.lit(0), F.lit(_BITS - 1))
    one = F.lit(1).cast("bigint")
    taken = F.filter(
        bits, lambda b: F.col(f"_w{w}").bitwiseAND(F.call_function("shiftleft", one, b)) != 0
    )
    return F.transform(taken, lambda b: first + b)


def _stored(df: DataFrame) -> tuple[DataFrame, int]:
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def mark_members(
    rows: DataFrame, column: str, parents: DataFrame, key: str, out: str, most: int | None = None
) -> DataFrame:
    """Adds ``out``: true where ``column`` is among the ids ``key`` of ``parents``, else null.

    Nulls on either side are not members, and an id that several parents have counts once.
    With up to ``most`` rows of bits (``MOST_ROWS``) every task gets them and the rows stay
    where they are; else they are joined with the distinct ids.
    """
    bits, n = _stored(id_bits(parents, key))
    value = F.col(column).cast("bigint")
    if n <= (MOST_ROWS if most is None else most):
        word = F.col("_w0")
        for k in range(1, _WORDS):
            word = F.when(_word(value) == k, F.col(f"_w{k}")).otherwise(word)
        found = word.bitwiseAND(_bit(value)) != 0
        placed = rows.withColumn("_block", F.shiftright(value, 9))
        marked = placed.join(F.broadcast(bits), "_block", "left")
        return marked.withColumn(out, F.when(found, F.lit(True))).drop("_block", *bits.columns)
    # The rows of bits give the ids back, each once.
    each = F.flatten(F.array(*[_ids_in(w) for w in range(_WORDS)]))
    ids = bits.select(F.explode(each).alias(column))
    # Shuffled once more, so that a join can split the rows of a hot id.
    ids = ids.groupBy(column, spread(column)).agg(F.lit(True).alias(out)).drop("_spread")
    return rows.join(ids, column, "left")
