"""Relational operators as DataFrame -> DataFrame functions.

They only declare logical plans; Catalyst pushes the filters into the Parquet
scan, prunes columns, and AQE chooses join strategies from measured sizes
(broadcast below ``spark.sql.adaptive.autoBroadcastJoinThreshold``,
sort-merge with skew splitting above it). No operator broadcasts on its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.scalars import literal_like, money_sum, string_array

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- F: projections and filters ----------------------------------------------

def where_equals(df: DataFrame, **values) -> DataFrame:
    """``col = literal`` for every keyword given."""
    cond = F.lit(True)
    for name, value in values.items():
        cond = cond & (F.col(name) == literal_like(value, df.schema[name].dataType))
    return df.where(cond)


def where_between(df: DataFrame, column: str, lo, hi) -> DataFrame:
    """half-open range ``lo <= col < hi``.

    Bounds are cast to the column's own type (``TIMESTAMP``, ``TIMESTAMP_NTZ``,
    ``DATE`` ...) so the comparison needs no cast of the column and reaches the
    Parquet reader as a pushed filter. Offset literals such as
    ``'2026-01-01 00:00:00+05:45'`` become UTC instants.
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= literal_like(lo, dtype))
    if hi is not None:
        cond = cond & (c < literal_like(hi, dtype))
    return df.where(cond)


def where_in(df: DataFrame, column: ColumnOrName, allowed: Sequence) -> DataFrame:
    """F7 (positive form): value inside an allowed domain."""
    return df.where(_col(column).isin(list(allowed)))


def contains_all(column: ColumnOrName, wanted: Sequence[str]) -> Column:
    """F8: ``tags @> ARRAY[...]`` - every wanted element is present.

    NULL arrays are not selected; an empty wanted list selects every non-NULL array.
    """
    col = _col(column)
    wanted = list(wanted)
    if len(wanted) == 1:
        cond = F.array_contains(col, wanted[0])
    else:
        cond = F.size(F.array_except(string_array(wanted), col)) == 0
    return col.isNotNull() & F.coalesce(cond, F.lit(False))


def where_contains_all(df: DataFrame, column: str, wanted: Sequence[str]) -> DataFrame:
    return df.where(contains_all(column, wanted))


# --- J: joins ------------------------------------------------------------------

def join_chain(base: DataFrame, *steps: tuple[DataFrame, str | Sequence[str]]) -> DataFrame:
    """A chain of inner equi-joins ``base ⋈ d1 ⋈ d2 ...``.

    Each step is ``(frame, key)`` with the key name shared by both sides; NULL
    keys never match, so rows with a NULL foreign key drop out (J3).
    """
    out = base
    for frame, key in steps:
        out = out.join(frame, on=key, how="inner")
    return out


def semi_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``EXISTS``: rows of ``df`` with a partner in ``keys``."""
    return df.join(keys, on=on, how="left_semi")


def anti_join(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """``NOT EXISTS``: rows of ``df`` without a partner in ``keys``."""
    return df.join(keys, on=on, how="left_anti")


# --- A: aggregation -----------------------------------------------------------

def grouped_totals(
    df: DataFrame,
    keys: Sequence[str],
    amount: str,
    total_alias: str = "total_amount",
    count_alias: str | None = "txn_count",
) -> DataFrame:
    """A1/A2: ``sum(amount)`` (exact, as money) and ``count(*)`` per group.

    Partial aggregation runs before the shuffle, so a hot key is combined on
    the map side and never sends more than one row per task downstream.
    """
    aggs = [money_sum(amount).alias(total_alias)]
    if count_alias:
        aggs.append(F.count(F.lit(1)).alias(count_alias))
    return df.groupBy(*keys).agg(*aggs)


def explode_counts(
    df: DataFrame, array_col: str, value_alias: str = "tag", count_alias: str = "customer_count"
) -> DataFrame:
    """X4 + A3: ``unnest(array)`` then ``count(*)`` per element.

    ``explode`` (not ``explode_outer``): empty and NULL arrays yield no row.
    """
    return (
        df.select(F.explode(F.col(array_col)).alias(value_alias))
        .groupBy(value_alias)
        .agg(F.count(F.lit(1)).alias(count_alias))
    )


def row_count(df: DataFrame, alias: str = "rows") -> DataFrame:
    """A4: global ``count(*)``."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def labelled_counts(
    tables: Mapping[str, DataFrame], label: str = "table_name", alias: str = "rows"
) -> DataFrame:
    """A4 + U1: ``SELECT 'name', count(*) ... UNION ALL ...`` over several tables."""
    out = None
    for name, frame in tables.items():
        part = frame.agg(F.count(F.lit(1)).alias(alias)).select(
            F.lit(name).alias(label), F.col(alias)
        )
        out = part if out is None else out.unionByName(part)
    return out


# --- W: windows -----------------------------------------------------------------

def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order_desc: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order_desc`` tuple per key (``row_number() = 1``).

    Catalyst plans ``row_number() ... = 1`` as a partial ``WindowGroupLimit``
    before the shuffle and a final one after it, so a key that holds a third
    of all rows is cut to one row per map task before it is exchanged. The
    order columns double as tie-breaks, which makes the result deterministic
    (the original leaves ties unordered). NULL order values sort first, as
    PostgreSQL does for ``DESC``.
    """
    keys = list(keys)
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    return first_per_key(df, keys, [F.col(c).desc_nulls_first() for c in order_desc], columns)


def first_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None
) -> DataFrame:
    """The first row per key under an arbitrary ordering (mixed directions allowed)."""
    from pyspark.sql.window import Window

    keys = list(keys)
    columns = list(columns) if columns is not None else [c for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(w))
        .where(F.col("_rn") == 1)
        .select(*keys, *[c for c in columns if c not in keys])
    )


def rank_within(
    df: DataFrame,
    partition_by: Sequence[str],
    order_col: str,
    alias: str = "spend_rank",
    descending: bool = True,
) -> DataFrame:
    """``rank() over (partition by k order by v desc)``; ties share a rank, gaps follow."""
    from pyspark.sql.window import Window

    order = F.col(order_col).desc_nulls_first() if descending else F.col(order_col).asc_nulls_last()
    w = Window.partitionBy(*partition_by).orderBy(order)
    return df.withColumn(alias, F.rank().over(w))


# --- T: sorts and top-k ----------------------------------------------------------

def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """``ORDER BY ... LIMIT k`` -> ``TakeOrderedAndProject`` (per-task top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def sort_total(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Total order over several keys (range-partitioned sort)."""
    return df.orderBy(*order)


def asc(c: str) -> Column:
    """PostgreSQL ascending order: NULLs last."""
    return F.col(c).asc_nulls_last()


def desc(c: str) -> Column:
    """PostgreSQL descending order: NULLs first."""
    return F.col(c).desc_nulls_first()
