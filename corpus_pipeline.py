"""From raw documents to a training mix, in stages that each read what the last one kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillwork.llm.decontaminate import without_contaminated
from tillwork.llm.mixture import mixed_documents
from tillwork.llm.near_dups import one_of_each
from tillwork.llm.secret_scan import without_secrets
from tillwork.llm.toxicity import without_toxic
from tillwork.llm.workspace import Workspace

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents predicted to be toxic, by a model of the labelled ones."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    return one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in place of each secret."""
    return without_secrets(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document may be there twice."""
    return mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("near_duplicates", deduplicate),
    ("decontamination", decontaminate),
    ("secrets", redact),
    ("mixture", mix),
]

# A trained model, signatures and edit distances have no SQL form; see the tests.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written and read again."""
    work = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = work.put(stage(spark, docs, sf_dir))
    return docs
