"""Keys with too many rows for one task.

A window over a key puts all its rows into one task, and adaptive execution
cannot split it. The ordered operators therefore find such keys and treat them
apart. A join with a hot key adaptive execution does split, given the chance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this many rows a key is cheap to handle in one task.
MIN_HOT_ROWS = 1_000_000


def hot_keys(
    df: DataFrame,
    keys: list[str],
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Keys with more than ``min_rows`` rows, at most one for each ``min_rows`` rows.

    Whether that is few enough to broadcast is for Spark to see at run time.
    """
    sizes = df.groupBy(*keys, spread(*keys)).agg(F.count(F.lit(1)).alias("_rows"))
    return sizes.filter(F.col("_rows") > min_rows).select(*keys)


def split_hot(
    df: DataFrame, keys: list[str], min_rows: int = MIN_HOT_ROWS
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``df`` as (rows of usual keys, rows of hot keys, the hot keys).

    With no hot key the second part is found empty at run time and not computed.
    """
    hot = hot_keys(df, keys, min_rows)
    usual = df.join(hot, keys, "left_anti")
    busy = df.join(hot, keys, "left_semi")
    return usual, busy, hot


def spread(*keys: str) -> Column:
    """A second grouping column, for a table reduced by ``keys`` that is then joined on them.

    Adaptive execution splits the skewed partitions of a join only if both sides
    come straight from a shuffle. A table grouped by the join keys alone would skip
    that shuffle, and so rob the other side of the split. Grouped by this column as
    well, which the keys determine, it has the same rows and is shuffled once more.
    """
    return F.xxhash64(*keys).alias("_spread")
