"""Deduplication and merges as DataFrame joins.

Parquet tables have no ``MERGE``; an upsert is the new version of the target
computed as ``target ⋈anti source ∪ source``. Both sides are unique on the key
(the source is deduplicated first), so the join has no hot key even when the
data is skewed, and AQE may broadcast the smaller side when its measured size
is under the threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILE_PATH = "_file_path"
FILE_BLOCK = "_file_block"
FILE_ROW = "_file_row"
POSITION = [FILE_PATH, FILE_BLOCK, FILE_ROW]


def with_file_position(df: DataFrame) -> DataFrame:
    """Attach the position of each row in its source file, taken at the scan.

    ``(_metadata.file_path, _metadata.file_block_start, monotonically_increasing_id())``
    sorts rows in file order: within one split the id grows with the row, and
    splits of a file are ordered by their start offset. Across files the order
    follows the file name. Must be applied directly on a file scan, before any
    shuffle.
    """
    return df.select(
        "*",
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_block_start").alias(FILE_BLOCK),
        F.monotonically_increasing_id().alias(FILE_ROW),
    )


def dedupe(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    keep: str = "first",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """M1/M3: one row per key; the first or last by ``order_by``.

    ``ON CONFLICT DO NOTHING`` keeps the first row in input order (M1); a row
    loop of upserts leaves the last one (M3). Planned as ``row_number() = 1``:
    a partial ``WindowGroupLimit`` runs before the shuffle, so a key holding a
    third of the input is reduced to one row per map task instead of landing
    whole in one reducer. Ties in ``order_by`` are broken by the remaining
    columns, so the result is deterministic.
    """
    from ledgerflow.operators.relational import first_per_key

    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    keys = list(keys)
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    order = list(order_by) + [c for c in columns if c not in order_by and c not in keys]
    if keep == "first":
        spec = [F.col(c).asc_nulls_first() for c in order]
    else:
        spec = [F.col(c).desc_nulls_last() for c in order]
    return first_per_key(df, keys, spec, columns)


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M2: ``INSERT ... ON CONFLICT (keys) DO UPDATE SET <all non-key columns>``.

    Rows of ``source`` replace target rows with the same key (source NULLs win,
    decided by presence, not by value); other target rows stay. ``source``
    must already be unique on ``keys`` (see :func:`dedupe`).
    """
    keys = list(keys)
    src = source.select(*target.columns)
    kept = target.join(src.select(*keys), on=keys, how="left_anti")
    return kept.unionByName(src)


def insert_if_absent(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M4: ``ON CONFLICT (keys) DO NOTHING``: only new keys are added."""
    keys = list(keys)
    src = source.select(*target.columns)
    new = src.join(target.select(*keys), on=keys, how="left_anti")
    return target.unionByName(new)


def merge_keep(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    keep_from_target: Sequence[str],
    defaults: Mapping[str, Column],
) -> DataFrame:
    """M3: upsert where some columns (e.g. ``created_at``) keep the target's value.

    A full outer join on the (unique) key: matched rows take the source's
    values except ``keep_from_target``; new rows take ``defaults`` for those;
    target rows without a source partner are kept as they are.
    """
    keys = list(keys)
    cols = [c for c in target.columns if c not in keys]
    t = target.select(*keys, *[F.col(c).alias(f"_t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s_cols = [c for c in cols if c in source.columns]
    s = source.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in s_cols], F.lit(True).alias("_in_s"))
    j = t.join(s, on=keys, how="full_outer")
    in_s = F.col("_in_s").isNotNull()
    in_t = F.col("_in_t").isNotNull()
    out = []
    for c in cols:
        if c in keep_from_target:
            new_value = defaults[c] if c in defaults else F.lit(None)
            out.append(F.when(in_t, F.col(f"_t_{c}")).otherwise(new_value).alias(c))
        elif c in s_cols:
            out.append(F.when(in_s, F.col(f"_s_{c}")).otherwise(F.col(f"_t_{c}")).alias(c))
        else:
            out.append(F.col(f"_t_{c}").alias(c))
    return j.select(*keys, *out)


def with_columns(df: DataFrame, computed: Mapping[str, Column]) -> DataFrame:
    """M7: insert-select with computed columns (``txn_day``, ``last_run_id``)."""
    return df.withColumns(dict(computed))
