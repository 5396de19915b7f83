"""CSV feeds: every column is read as text, types come with cleaning."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwork.functions.text import null_words
from tillwork.session import shared_folder

POSITION = "_position"


def read_feed(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    *,
    position: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Headered CSV as text columns, with the words for "no value" read as null.

    ``position`` adds a column that orders the rows as they stand in the files:
    by path, then by place in the file. Cleaning uses it to tell which of several
    equal rows came first. ``multi_line`` allows line breaks inside quotes, at the
    price that one file is then read by one task.
    """
    raw = (
        spark.read.schema(", ".join(f"{c} string" for c in columns))
        .option("header", True)
        .option("escape", '"')
        .option("multiLine", multi_line)
        .csv(path)
    )
    fields = [null_words(F.col(c)).alias(c) for c in columns]
    if not position:
        return raw.select(*fields)
    return raw.select(
        *fields,
        F.struct(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(POSITION),
    )


def positioned(raw: DataFrame, folder: str | None = None) -> DataFrame:
    """``raw`` with the column ``POSITION``, which it keeps if it has one.

    Rows that come out of a shuffle have no place of their own: each time they are computed
    they may stand elsewhere. So they are numbered and written once, to ``folder`` or a new one
    all executors share, and read from there.
    """
    if POSITION in raw.columns:
        return raw
    path = f"{folder or shared_folder(raw.sparkSession)}/{uuid.uuid4().hex}"
    numbered = raw.withColumn(POSITION, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return raw.sparkSession.read.schema(numbered.schema).parquet(path)


def with_file_ids(feed: DataFrame, id_column: str) -> DataFrame:
    """Numbers the rows 1, 2, 3 ... in file order, for feeds that carry no id.

    ``feed`` comes from ``read_feed(position=True)``. Rows of one split of a file
    have consecutive places, so a split needs only its first place and its row
    count. The one window runs over the splits, of which there is one for every
    ``spark.sql.files.maxPartitionBytes`` of input.
    """
    path, start, row = (f"{POSITION}.{part}" for part in ("path", "start", "row"))
    splits = feed.groupBy(F.col(path).alias("_path"), F.col(start).alias("_start")).agg(
        F.min(row).alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    ahead = Window.orderBy("_path", "_start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_ahead", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)))
    names = [c for c in feed.columns if c != POSITION]
    return feed.join(
        splits, (F.col(path) == F.col("_path")) & (F.col(start) == F.col("_start"))
    ).select((F.col(row) - F.col("_first") + F.col("_ahead") + 1).alias(id_column), *names)
