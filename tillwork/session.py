"""Spark session settings and the shared working folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution does three jobs for this library: it splits skewed join
# partitions, merges small shuffle partitions, and turns a join into a broadcast
# once the size of the small side has been measured.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot partition even if the next join then needs a shuffle it could
    # have done without.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

MB = 2**20


def settings_for(input_bytes: int) -> dict[str, str]:
    """Task sizes for a cluster job that reads ``input_bytes``.

    Reads come in splits of 128 to 512 MB. Of what is read, less than half is
    shuffled once columns are pruned, so one shuffle partition for each 512 MB of
    input stays within a task's memory. More than 40,000 partitions would cost the
    driver more in bookkeeping than smaller tasks gain; beyond that, tasks spill.
    """
    split = min(max(input_bytes // 100_000, 128 * MB), 512 * MB)
    partitions = min(max(input_bytes // (512 * MB), 200), 40_000)
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(partitions),
        # Merge what turns out small up to this size, instead of filling all cores.
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * MB),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }


def build_session(
    app: str, master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the library's settings; ``settings`` adds to or replaces them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, base: str | None = None) -> str:
    """A new folder for one run, below the folder every executor can reach.

    That is ``base``, or what the cluster names in ``spark.checkpoint.dir``. Only a local
    session, where all tasks share one disk, may do without and use its warehouse.
    """
    base = base or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir', 'spark-warehouse')}/_staging"
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read from there, so that the work behind it is done once
    however many passes follow."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
