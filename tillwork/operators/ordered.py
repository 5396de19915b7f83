"""Running sums, neighbours and row numbers over one long order.

A window without PARTITION BY, or over a key that holds a large part of the
table, runs in a single task. These operators cut the order into groups instead.
``levels`` are columns from coarse to fine whose order agrees with the row order,
such as a day and a block of ids. Each group is reduced to one value before
anything is shuffled. Windows over those values give what every group receives
from the groups ahead of it. That value enters the group as one extra row in
front of the others (or behind them, when looking ahead), so the rows are
shuffled once, need no join, and no task sees more than one group.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tillwork.operators.hot import MIN_HOT_ROWS, hot_keys

# A block of 2^20 unique ids holds at most 2^20 rows.
BLOCK_BITS = 20
# Blocks for each shuffle partition, so that hashing them deals rows out evenly.
BLOCKS_PER_PARTITION = 8
# A table is cut into this many blocks at most; it is what the driver sees of the ids.
MOST_BLOCKS = 2**16
# Cells that the range of the ids, or of a crowded part of it, is counted in.
CELLS = 2**12
FINER_CELLS = 2**8

_HEAD, _ROW, _TAIL = 0, 1, 2


def id_block(key: str, bits: int = BLOCK_BITS) -> Column:
    """Blocks of consecutive whole-number ids, in id order."""
    return F.shiftright(F.col(key).cast("bigint"), bits)


def _looked_up(values: list[int], index: Column) -> Column:
    """The value at a place of a fixed list, which the optimizer folds into an array."""
    return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), index)


def _pieces(low: int, high: int, most: int) -> int:
    """Low bits to drop so that the ids from ``low`` to ``high`` give at most ``most`` values."""
    bits = 0
    while (high >> bits) - (low >> bits) >= most:
        bits += 1
    return bits


@dataclass(frozen=True)
class Cut:
    """Blocks of an id: their number as a column, in id order, how many there are, and the
    rows of the largest."""

    block: Column
    blocks: int
    largest: int


def cut(df: DataFrame, key: str, wanted: Callable[[int], int]) -> Cut:
    """Cuts the order of whole-number ids into about ``wanted(rows)`` blocks of like size.

    The rows are counted in cells of equal width over the range of the ids. Cells with more
    rows than a block should have, as where ids crowd or one outlier stretches the range, are
    counted again in finer cells over their own range, and so on; then neighbouring cells are
    put together. Each count is one pass over the id column, and one is enough for ids that
    are spread evenly. A table of at most one block's rows is not counted in cells at all. A
    block has more than twice its share only if a single id has.
    """
    low, high, n = df.agg(F.min(key), F.max(key), F.count(key)).first()
    blocks = min(max(wanted(n), 1), MOST_BLOCKS)
    ids = F.col(key).cast("bigint")
    if blocks == 1:
        # By sign: a constant would leave the joins over blocks without a key.
        return Cut(F.shiftright(ids, 63), 1, n)
    bits = _pieces(low, high, CELLS if n > 2**BLOCK_BITS else blocks)
    cell = F.shiftright(ids, bits) - F.lit(low >> bits)
    if n <= 2**BLOCK_BITS:
        return Cut(cell, (high >> bits) - (low >> bits) + 1, n)
    number = (high >> bits) - (low >> bits) + 1
    share = math.ceil(n / blocks)
    while True:
        counted = df.filter(ids.isNotNull()).groupBy(cell.alias("cell")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(ids).alias("low"), F.max(ids).alias("high")
        )
        found = {r["cell"]: r for r in counted.collect()}  # at most one row for each cell
        heavy = {c for c, r in found.items() if r["rows"] > share and r["low"] < r["high"]}
        if not heavy:
            break
        firsts, drops, starts, next_ = [], [], [], 0
        for c in range(number):
            firsts.append(next_)
            r = found.get(c)
            if c in heavy:
                pieces = max(4 * r["rows"] // share, min(FINER_CELLS, MOST_BLOCKS // len(heavy)))
                drop = _pieces(r["low"], r["high"], pieces)
                next_ += (r["high"] >> drop) - (r["low"] >> drop) + 1
            else:
                drop = 63
                next_ += 1
            drops.append(drop)
            starts.append((r["low"] if r else 0) >> drop)
        inside = F.call_function("shiftright", ids, _looked_up(drops, cell).cast("int"))
        cell = _looked_up(firsts, cell) + inside - _looked_up(starts, cell)
        number = next_
    block_of, block, held, largest = [], 0, 0, 0
    for c in range(number):
        rows = found[c]["rows"] if c in found else 0
        if held and held + rows > share:
            block, held = block + 1, 0
        held += rows
        largest = max(largest, held)
        block_of.append(block)
    return Cut(_looked_up(block_of, cell), block + 1, largest)


def spread_blocks(df: DataFrame, key: str) -> Column:
    """Blocks of whole-number ids, below a level such as a day, that follow the rows of
    ``df`` and not its ids: about one for each 2^BLOCK_BITS rows, however the ids lie."""
    return cut(df, key, lambda n: math.ceil(n / 2**BLOCK_BITS)).block


def id_levels(df: DataFrame, key: str) -> list[Column]:
    """Levels for an order by one whole-number id: blocks as in ``spread_blocks``, but some for
    each shuffle partition, and above them about the root of their number."""
    return levels_of(_for_partitions(df, key))


def _for_partitions(df: DataFrame, key: str) -> Cut:
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = BLOCKS_PER_PARTITION * partitions
    return cut(df, key, lambda n: max(n >> BLOCK_BITS, min(some, n >> 10)))


def levels_of(blocks: Cut) -> list[Column]:
    """The blocks, and above them about the root of their number."""
    return [F.shiftright(blocks.block, blocks.blocks.bit_length() // 2), blocks.block]


@dataclass(frozen=True)
class _Scan:
    """How groups are reduced and what a group receives from the others."""

    reduce_rows: Callable[[], Column]
    reduce_groups: Callable[[str], Column]
    within: Callable[[WindowSpec], Column]
    is_first: Callable[[WindowSpec], Column]
    join: Callable[[Column, Column], Column]
    place: int
    final: Callable[[WindowSpec], Column]


def _carried(groups: DataFrame, part: list[str], levels: list[str], scan: _Scan) -> DataFrame:
    """``groups`` with ``_carry``, the value from the other side, and ``_end``, true if none."""
    *outer, last = levels
    order = Window.partitionBy(*part, *outer).orderBy(last)
    keys = [*part, *outer]
    inner = groups.withColumn("_carry", scan.within(order)).withColumn("_end", scan.is_first(order))
    if not outer:
        return inner
    parents = groups.groupBy(*keys).agg(scan.reduce_groups(last).alias("_v"))
    parents = _carried(parents, part, outer, scan).select(
        *[F.col(k).alias(f"_p{i}") for i, k in enumerate(keys)],
        F.col("_carry").alias("_outer"),
        F.col("_end").alias("_outer_end"),
    )
    same = reduce(
        lambda a, b: a & b,
        (F.col(k).eqNullSafe(F.col(f"_p{i}")) for i, k in enumerate(keys)),
    )
    return inner.join(parents, same).select(
        *part,
        *levels,
        "_v",
        scan.join(F.col("_carry"), F.col("_outer")).alias("_carry"),
        (F.col("_end") & F.col("_outer_end")).alias("_end"),
    )


def _apply(
    df: DataFrame,
    out: str,
    value: Column,
    order_by: list[str | Column],
    levels: list[Column],
    part: list[str],
    scan: _Scan,
) -> DataFrame:
    names = [f"_l{i}" for i in range(len(levels))]
    rows = df.select(
        "*",
        *[c.alias(n) for c, n in zip(levels, names)],
        value.alias("_v"),
        F.lit(_ROW).alias("_place"),
    )
    groups = rows.groupBy(*part, *names).agg(scan.reduce_rows().alias("_v"))
    extra = (
        _carried(groups, part, names, scan)
        .filter(~F.col("_end"))
        .select(*part, *names, F.col("_carry").alias("_v"), F.lit(scan.place).alias("_place"))
    )
    order = Window.partitionBy(*part, *names).orderBy("_place", *order_by)
    return (
        rows.unionByName(extra, allowMissingColumns=True)
        .withColumn(out, scan.final(order))
        .filter(F.col("_place") == _ROW)
        .select(*df.columns, out)
    )


def running_sum(
    df: DataFrame,
    out: str,
    value: Column,
    to: str,
    *,
    order_by: list[str | Column],
    levels: list[Column],
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` up to and including each row, as type ``to``.

    ``order_by`` orders the rows inside one group; ``value`` must not be null.
    """
    scan = _Scan(
        reduce_rows=lambda: F.sum("_v").cast(to),
        reduce_groups=lambda last: F.sum("_v").cast(to),
        within=lambda w: F.coalesce(
            F.sum("_v").over(w.rowsBetween(Window.unboundedPreceding, -1)).cast(to),
            F.lit(0).cast(to),
        ),
        is_first=lambda w: F.row_number().over(w) == 1,
        join=lambda inner, outer: (inner + outer).cast(to),
        place=_HEAD,
        final=lambda w: F.sum("_v")
        .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .cast(to),
    )
    return _apply(df, out, value.cast(to), order_by, levels, list(partition_by or []), scan)


def previous_value(
    df: DataFrame, out: str, value: str, *, key: str, levels: list[Column]
) -> DataFrame:
    """Adds ``out``: the value of the row before; ``key`` is unique and orders each group."""
    scan = _Scan(
        reduce_rows=lambda: F.max_by("_v", key),
        reduce_groups=lambda last: F.max_by("_v", last),
        within=lambda w: F.lag("_v").over(w),
        is_first=lambda w: F.lag(F.lit(True)).over(w).isNull(),
        join=lambda inner, outer: F.when(F.col("_end"), outer).otherwise(inner),
        place=_HEAD,
        final=lambda w: F.lag("_v").over(w),
    )
    return _apply(df, out, F.col(value), [key], levels, [], scan)


def next_value(df: DataFrame, out: str, value: str, *, key: str, levels: list[Column]) -> DataFrame:
    """Adds ``out``: the value of the row after; ``key`` is unique and orders each group."""
    scan = _Scan(
        reduce_rows=lambda: F.min_by("_v", key),
        reduce_groups=lambda last: F.min_by("_v", last),
        within=lambda w: F.lead("_v").over(w),
        is_first=lambda w: F.lead(F.lit(True)).over(w).isNull(),
        join=lambda inner, outer: F.when(F.col("_end"), outer).otherwise(inner),
        place=_TAIL,
        final=lambda w: F.lead("_v").over(w),
    )
    return _apply(df, out, F.col(value), [key], levels, [], scan)


def row_numbers(
    df: DataFrame,
    out: str,
    *,
    order_by: list[str | Column],
    levels: list[Column],
    partition_by: list[str] | None = None,
) -> DataFrame:
    """Adds ``out``: 1, 2, 3 ... along the order, without gaps."""
    return running_sum(
        df,
        out,
        F.lit(1),
        "bigint",
        order_by=order_by,
        levels=levels,
        partition_by=partition_by,
    )


def row_numbers_split(
    df: DataFrame,
    out: str,
    *,
    key: str,
    order_by: list[str | Column],
    finer: Column,
    min_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Like :func:`row_numbers`, for an order that begins with a whole number which may repeat.

    Blocks of ``key`` hold about the same number of rows, unless one value fills a block
    alone. Only if the count of the blocks shows such a value, the blocks found hot are cut
    further, by ``finer``.
    """
    blocks = _for_partitions(df, key)
    levels = levels_of(blocks)
    if blocks.largest <= min_rows:
        return row_numbers(df, out, order_by=order_by, levels=levels)
    blocked = df.withColumn("_block", levels[-1])
    hot = hot_keys(blocked, ["_block"], min_rows).withColumn("_hot", F.lit(True))
    marked = blocked.join(hot, "_block", "left")
    further = F.when(F.col("_hot"), finer)
    return row_numbers(marked, out, order_by=order_by, levels=[*levels, further]).drop(
        "_block", "_hot"
    )


def rank_by_amount(
    df: DataFrame, out: str, *, partition_by: list[str], amount: str, width: int = 1_000
) -> DataFrame:
    """Adds ``out``: the rank of each row by ``amount``, largest first; equal amounts share a rank.

    The amount must not be null; a null in a partition column is a value like any other.
    Works on the distinct amounts, cut into ranges of ``width``. Amounts have two
    decimal places, so a range holds at most ``100 * width`` of them, however
    many rows the partition or a single amount has.
    """
    amounts = df.groupBy(*partition_by, amount).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sum(
        amounts,
        "_upto",
        F.col("_n"),
        "bigint",
        order_by=[F.desc(amount)],
        levels=[-F.floor(F.col(amount) / width)],
        partition_by=partition_by,
    ).select(
        *[F.col(c).alias(f"_k{i}") for i, c in enumerate([*partition_by, amount])],
        (F.col("_upto") - F.col("_n") + 1).alias(out),
    )
    same = reduce(
        lambda a, b: a & b,
        (F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate([*partition_by, amount])),
    )
    return df.join(ranked, same).select(*df.columns, out)
