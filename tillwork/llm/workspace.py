"""Tables written between the steps of one run, in the folder all executors share."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tillwork.plans.versions import remove
from tillwork.session import shared_folder


# Shuffle files go when the write that made them has ended, not when the driver collects
# its garbage.
_CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """A new folder below ``spark.checkpoint.dir``.

    A table put here no longer depends on what it was made from, so a lost executor
    costs only the tasks it was running. What its making shuffled is deleted at once.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = shared_folder(spark)
        self.tables = 0
        self.paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()

    def put_observed(self, df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
        """A table, and measures of its rows that are taken while it is written."""
        seen = Observation()
        stored = self.put(df.observe(seen, *[m.alias(n) for n, m in measures.items()]))
        return stored, seen.get

    def put(self, df: DataFrame) -> DataFrame:
        self.tables += 1
        path = f"{self.folder}/{self.tables}"
        before = self.spark.conf.get(_CLEAN_UP, None)
        self.spark.conf.set(_CLEAN_UP, "true")
        try:
            df.write.parquet(path)
        finally:
            if before is None:
                self.spark.conf.unset(_CLEAN_UP)
            else:
                self.spark.conf.set(_CLEAN_UP, before)
        stored = self.spark.read.schema(df.schema).parquet(path)
        self.paths[stored] = path
        return stored

    def drop(self, *stored: DataFrame) -> None:
        """Deletes tables that nothing to come reads."""
        for table in stored:
            remove(self.spark, self.paths[table])


def map_batches(
    df: DataFrame,
    schema: str,
    make: Callable[[], Callable[[dict[str, list]], dict[str, object]]],
    most_bytes: int | None = None,
) -> DataFrame:
    """Turns each Arrow batch of ``df`` into rows of ``schema``, inside the tasks.

    ``make`` is called once for each task and gives the function from columns (lists)
    to columns (lists, arrays or numpy arrays). Spark bounds a batch by rows and bytes; where
    the work takes many times the size of its input, ``most_bytes`` has it done in parts of
    about that size.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            rows = n if not most_bytes else max(1, n * most_bytes // max(batch.nbytes, 1))
            for start in range(0, n, max(rows, 1)):
                yield batch.slice(start, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = make()
        for batch in parts(batches):
            out = convert({n: batch.column(n).to_pylist() for n in batch.schema.names})
            yield pa.RecordBatch.from_arrays(
                [
                    out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                    for f in target
                ],
                schema=target,
            )

    return df.mapInArrow(run, schema)


def lists(rows: list, kind: pa.DataType) -> pa.Array:
    """An Arrow list column of numpy arrays."""
    import numpy as np

    ends = np.cumsum([0] + [len(r) for r in rows])
    flat = np.concatenate(rows) if rows else np.empty(0)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, kind))
