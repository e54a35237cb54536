"""Corpus pipeline: quality rules, near-duplicate join, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import decontaminate, histogram_sort, mix, ngram_join, quality_rules
from ledgerflow.llm.common import prepare, read, release, scratch_path, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line labels and base rules keep."""
    prepare(spark)
    return quality_rules.keep_content(docs, read(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked documents, the one with the smallest doc_id."""
    prepare(spark)
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    prepare(spark)
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of the documents that the mix takes, a row per document and turn."""
    prepare(spark)
    return mix.mixed_documents(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with their size, shard and slot."""
    prepare(spark)
    return histogram_sort.shard(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("mix_sources", mixing_stage),
    ("histogram_sort", sharding_stage),
]

#: The decoded lines and the pseudorandom mix have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written as Parquet and reread.

    A stage's intermediate tables go when its result is written; those of the last
    stage stay until the caller has written the rows and calls ``common.release``.
    """
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path, mark = scratch_path(spark, f"pipeline-{name}"), written()
        stage(spark, docs, sf_dir).write.parquet(path)
        release(spark, mark)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
