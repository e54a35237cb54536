"""Keyed tables written run by run: ``run_id=<r>`` Parquet partitions.

A run appends only its own rows. The table's content is the newest row per key
among the runs whose ledger event is ``success`` (W1 over J6), so a run's work
is proportional to its own rows, a failed run stays invisible, and a retried
run overwrites only its own partition. Reading pays one shuffle by key (with a
partial group limit before it) until :func:`rewrite` stores the current rows
as one plain table, which is an explicit maintenance step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators.ledger import successful_run_ids
from ledgerflow.operators.relational import latest_per_key
from ledgerflow.sources.files import append_partitioned, replace_table
from ledgerflow.sources.tables import read_or_empty

RUN = "run_id"


def append_run(df: DataFrame, path: str, run_id: int) -> None:
    """Store the rows of a run; a retry replaces them."""
    append_partitioned(df.withColumn(RUN, F.lit(run_id).cast("bigint")), path, [RUN])


def run_rows(
    spark: SparkSession, path: str, schema: T.StructType, ledger: DataFrame, staged_run: int | None = None
) -> DataFrame:
    """Rows of all successful runs with their ``run_id``; ``staged_run`` counts as successful."""
    full = T.StructType(list(schema.fields) + [T.StructField(RUN, T.LongType())])
    ok = successful_run_ids(ledger)
    if staged_run is not None:
        ok = ok.unionByName(spark.createDataFrame([(int(staged_run),)], f"{RUN} bigint")).distinct()
    return read_or_empty(spark, path, full).join(ok, RUN, "left_semi")


def newest_per_key(rows: DataFrame, key: str, first_value: Sequence[str] = ()) -> DataFrame:
    """The newest run's row of every key, without the run column.

    ``first_value`` columns (e.g. ``created_at``) keep the value of the key's
    earliest run. A run holds a key once, so the order is total.
    """
    cols = [c for c in rows.columns if c not in (RUN, key)]
    if not first_value:
        return latest_per_key(rows, [key], [RUN], cols)
    # One aggregate with a partial step: newest row and earliest values together.
    newest = F.max_by(F.struct(*[F.col(c) for c in cols if c not in first_value]), F.col(RUN)).alias("_newest")
    earliest = [F.min_by(F.col(c), F.col(RUN)).alias(c) for c in first_value]
    out = rows.groupBy(key).agg(newest, *earliest)
    return out.select(key, *[F.col(c) if c in first_value else F.col(f"_newest.{c}").alias(c) for c in cols])


def rewrite(current: DataFrame, path: str) -> None:
    """Store the current rows as one plain table for readers that scan it often."""
    replace_table(current, path)


def write_bucketed(current: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """Store the current rows as a catalog table of ``buckets`` buckets by key, each sorted by it.

    One exchange lines the rows up with the buckets, so a bucket is one file. Later
    joins and windows on the key read the table as it lies, without an exchange.
    """
    rows = current.repartition(buckets, key)
    rows.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def upsert_bucketed(spark: SparkSession, table: str, increment: DataFrame, key: str) -> DataFrame:
    """M2 over a bucketed table: its rows without those that ``increment`` replaces, and the increment.

    Only the increment is exchanged (to the table's buckets, or broadcast when its
    measured size is small); the table's side has the partitioning and order already.
    ``increment`` must be unique on the key.
    """
    target = spark.table(table)
    source = increment.select(*target.columns)
    return target.join(source.select(key), key, "left_anti").unionByName(source)


def newest_in_bucketed(spark: SparkSession, table: str, key: str, order: Sequence[str]) -> DataFrame:
    """W1 over a bucketed table that holds several versions of a key: no exchange, no sort of the table by key."""
    rows = spark.table(table)
    return latest_per_key(rows, [key], list(order), [c for c in rows.columns if c != key])
