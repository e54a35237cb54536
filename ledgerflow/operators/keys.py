"""Surrogate keys: consecutive ids in a given order, without a
single-partition window.

``row_number() OVER (ORDER BY k)`` with no partition moves every row into one
task. Instead the rows are range-partitioned and sorted by the order columns,
each row gets its position inside its partition, the per-partition row counts
(one small row per partition) are turned into start offsets, and the offsets
are joined back. The positioned rows are checkpointed to the shared
checkpoint folder first, so both uses see the same partitioning even if a task
or executor is lost and recomputed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerflow.session import ensure_checkpoint_dir

#: Rows that one sort task takes.
ROWS_PER_PARTITION = 2_000_000
_ROW_BITS = 33  # monotonically_increasing_id = partition_id << 33 | row_in_partition


def assign_surrogate_keys(
    df: DataFrame,
    order_by: Sequence[str | Column],
    alias: str = "surrogate_id",
    start: int = 1,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``alias`` = ``start + rank of the row in order_by`` (1-based, gap-free).

    ``order_by`` should be unique for a reproducible numbering (like an
    identity column fed in a fixed order). Names sort ascending with NULLs last;
    sort columns (``relational.asc`` / ``desc``) may be mixed, so the number is the
    row's position in a total sort (T3).
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    # The scan position breaks ties: rows with an equal order value (even a
    # third of the input) can then be split across range partitions instead of
    # all landing in one. Equal values are numbered in scan order.
    order = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order_by] + [F.col("_tie").asc()]
    # Partitions follow the input's size (AQE cannot split these sorts).
    n = num_partitions or max(1, -(-df.count() // ROWS_PER_PARTITION))
    positioned = (
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("_mid"), _ROW_BITS)
    row = F.col("_mid") - F.shiftleft(part, _ROW_BITS)
    # One row per partition: a bounded table (n rows), so the single-partition
    # window that turns counts into offsets is cheap, and the join back is a
    # broadcast of n rows.
    counts = positioned.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_part",
        (F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).alias("_off"),
    ).fillna(0, subset=["_off"])
    joined = positioned.withColumn("_part", part).withColumn("_row", row).join(
        F.broadcast(offsets), "_part", "inner"
    )
    return joined.select(
        *[c for c in df.columns],
        (F.col("_off") + F.col("_row") + F.lit(start)).cast("bigint").alias(alias),
    )
