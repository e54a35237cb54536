"""Sharding by histogram sort: exact splitters found by counting, then one exchange.

Every row gets a 64-bit sort key: the upper 40 bits hash its text, the lower 24
its id, so equal texts are neighbours while no group of equal texts is a single key.
Exact repeats of a row (id and text) share a key; where a group of them is large
enough to matter for the shards' sizes, its rows are numbered and hash their number
too. Nothing depends on how the input is partitioned, so copies are placed alike in
every run.
The boundaries of the shards are found by rounds of counting:
every round sums, over all partitions, the exact bytes and rows in the intervals
between probe keys, and puts new probes into each interval that still holds a
wanted boundary, until the bytes below every splitter are within its tolerance of
the wanted sum or its interval holds one row. Only then rows move, once. The driver
holds the boundaries of the shards and their probes, nothing that grows with the rows.

A shard is cut into ranges of about :data:`RANGE_BYTES`, the unit that a task sorts,
by equal steps of the text hash; a range that holds more, as one text with very many
copies makes it, is cut again by equal steps of the id hash. One count per range
gives the rows before it; a row's slot is that and its number in the range.

Defined cases: a null text has size :data:`ROW_BYTES` and the crc32 of no bytes;
null ids sort by the hash of null; repeated rows are all kept, each with a slot of
its own; an empty table gives no rows; other columns travel with their row.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import bounded, materialize

SHARDS = 24
#: Largest distance of a shard's boundary from its even place, as a share of a shard.
TOLERANCE = 0.002
#: Probes put into each interval that holds a boundary, per round.
PROBES = 15
#: Bytes of a range, the unit that one task sorts, and how many times that it may hold before it is cut again.
RANGE_BYTES, RANGE_SLACK = 32 << 20, 2
#: Most ranges to be cut again that are broadcast (about 32 bytes each); above, rows are shuffled to them.
BROADCAST_RANGES = 200_000
ROW_BYTES = 8
ROW_BITS = 24


def histogram(keys: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows of keys (_key, _size) in the intervals cut by sorted probes.

    Interval i holds the keys k with probes[i - 1] <= k < probes[i].
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(probes, b["_key"].to_numpy(), side="right")
            np.add.at(sizes, at, b["_size"].to_numpy())
            np.add.at(rows, at, 1)
        seen = np.flatnonzero(rows)
        yield pd.DataFrame({"i": seen, "size": sizes[seen], "rows": rows[seen]})

    found = keys.select("_key", "_size").mapInPandas(count, "i long, size long, rows long")
    found = found.groupBy("i").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).toPandas()
    sizes, rows = np.zeros(len(probes) + 1, np.int64), np.zeros(len(probes) + 1, np.int64)
    sizes[found["i"].to_numpy(dtype=int)] = found["size"]
    rows[found["i"].to_numpy(dtype=int)] = found["rows"]
    return sizes, rows


def splitters(keys: DataFrame, wanted: list[float], slack: list[float]) -> tuple[np.ndarray, np.ndarray, int]:
    """Splitter keys, the exact rows below each, and the number of counting rounds.

    A splitter is the smallest key of its upper side. The bytes below splitter i
    are within ``slack[i]`` of ``wanted[i]``, or no other key comes nearer.
    """
    n = len(wanted)
    # For each boundary the nearest known points from below and above: (key, bytes below, rows below).
    low, high = [(-(2**63), 0, 0)] * n, [(2**63 - 1, np.inf, np.inf)] * n
    rounds = 0

    def nearest(i: int) -> tuple[int, float, float]:
        return min(low[i], high[i], key=lambda p: abs(p[1] - wanted[i]))

    def is_open(i: int) -> bool:
        return abs(nearest(i)[1] - wanted[i]) > slack[i] and high[i][2] - low[i][2] > 1 and high[i][0] - low[i][0] > 1

    while open_ := [i for i in range(n) if is_open(i)]:
        new = {low[i][0] + (high[i][0] - low[i][0]) * j // (PROBES + 1) for i in open_ for j in range(1, PROBES + 1)}
        ends = {p[0] for i in open_ for p in (low[i], high[i])}
        probes = np.array(sorted(p for p in new | ends if p > -(2**63)), dtype=np.int64)
        sizes, rows = histogram(keys, probes)
        bytes_below, rows_below = sizes.cumsum()[:-1], rows.cumsum()[:-1]
        rounds += 1
        for i in open_:
            at = int(np.searchsorted(bytes_below, wanted[i], side="right"))  # probes before it are from below
            if at > 0 and int(probes[at - 1]) >= low[i][0]:
                low[i] = (int(probes[at - 1]), int(bytes_below[at - 1]), int(rows_below[at - 1]))
            if at < len(probes) and int(probes[at]) <= high[i][0]:
                high[i] = (int(probes[at]), int(bytes_below[at]), int(rows_below[at]))
    found = [nearest(i) for i in range(n)]
    return np.array([p[0] for p in found], dtype=np.int64), np.array([p[2] for p in found], dtype=np.int64), rounds


def _numbered(rows: DataFrame, large: DataFrame) -> DataFrame:
    """``rows`` with ``again``: 0, or the number of a row among the exact repeats in ``large`` (doc_id, text_bits).

    Each input partition numbers its own rows of a group, and one row per partition
    and group gives the numbers before.
    """
    same = ["doc_id", "text_bits"]
    on = rows["doc_id"].eqNullSafe(large["doc_id"]) & (rows["text_bits"] == large["text_bits"])
    own = rows.join(F.broadcast(large), on, "left_semi")
    parts = own.groupBy(*same, "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*same).orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(F.col("doc_id").alias("p_id"), F.col("text_bits").alias("p_bits"), F.col("part").alias("p_part"), F.coalesce(before, F.lit(0)).alias("before"))
    own = own.withColumn("number", F.row_number().over(Window.partitionBy(*same, "part").orderBy("at")))
    at = own["doc_id"].eqNullSafe(parts["p_id"]) & (own["text_bits"] == parts["p_bits"]) & (own["part"] == parts["p_part"])
    own = own.join(parts, at).withColumn("again", F.col("before") + F.col("number") - 1).select(*rows.columns, "again")
    rest = rows.join(F.broadcast(large), on, "left_anti").withColumn("again", F.lit(0).cast("long"))
    return materialize(rest.unionByName(own), "shard-numbered")


def sort_keys(docs: DataFrame, row: Column, share: float) -> tuple[DataFrame, int]:
    """(row, _size, _key, tie) of every document and the sum of sizes; ``tie`` orders rows of equal keys.

    Groups of exact repeats that hold more than ``share`` of all bytes are numbered:
    at most 1 / share of them, so their list is broadcast.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + ROW_BYTES
    rows = docs.select(
        row.alias("row"), size.alias("size"), "doc_id", F.xxhash64("text").alias("text_bits"),
        F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"),
    )
    rows = materialize(rows, "shard-rows")
    total = rows.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    groups = rows.groupBy("doc_id", "text_bits").agg(F.count("*").alias("times"), F.sum("size").alias("bytes"))
    large = materialize(groups.where((F.col("times") > 1) & (F.col("bytes") > share * total)).select("doc_id", "text_bits"), "shard-repeats")
    rows = rows.withColumn("again", F.lit(0).cast("long")) if large.isEmpty() else _numbered(rows, large)
    low = (1 << ROW_BITS) - 1
    id_bits = F.xxhash64("doc_id", "again").bitwiseAND(F.lit(low).cast("long"))
    key = F.col("text_bits").bitwiseAND(F.lit(~low).cast("long")).bitwiseOR(id_bits)
    # rows of one id and text differ, if at all, in other columns (maps have no hash)
    others = [F.col("row").getField(f.name) for f in rows.schema["row"].dataType.fields if "map<" not in f.dataType.simpleString()]
    return rows.select("row", F.col("size").alias("_size"), key.alias("_key"), F.xxhash64("doc_id", "again", *others).alias("tie")), total


def shard(
    docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, columns: Sequence[str] | None = None
) -> DataFrame:
    """``docs`` with shard, slot (gapless from 0 in each shard) and size in bytes.

    ``columns`` names the columns that travel (all by default). Clashing columns
    of ``docs`` named shard, slot or size are replaced.
    """
    own = [c for c in columns or docs.columns if c not in ("shard", "slot", "size")]
    row = F.struct(*[F.col(f"`{c}`") for c in own])  # a struct, so no column clashes with the helpers
    keyed, total = sort_keys(docs, row, tolerance / shards / 4)
    wanted = [total * i / shards for i in range(1, shards)]
    keys, _, _ = splitters(keyed, wanted, [tolerance * total / shards] * len(wanted))

    @pandas_udf("int")
    def shard_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(keys, key.to_numpy(), side="right").astype(np.int32))

    # equal steps of the upper bits (as a number from 0), in all shards together
    ranges = max(1, min(1 << 22, -(-total // RANGE_BYTES)))
    upper = F.shiftright("_key", ROW_BITS) + F.lit(1 << (63 - ROW_BITS))
    step = F.shiftright(upper * F.lit(ranges), 64 - ROW_BITS)
    placed = keyed.select("row", "_size", "_key", "tie", shard_of("_key").alias("shard"), step.alias("step"))
    sizes = placed.groupBy("shard", "step").agg(F.sum("_size").alias("bytes"))
    full = sizes.where(F.col("bytes") > RANGE_SLACK * RANGE_BYTES).select("shard", "step", F.ceil(F.col("bytes") / RANGE_BYTES).alias("cuts"))
    placed = placed.join(bounded(materialize(full, "shard-ranges"), BROADCAST_RANGES), ["shard", "step"], "left")
    low = F.col("_key").bitwiseAND(F.lit((1 << ROW_BITS) - 1).cast("long"))
    placed = placed.withColumn("cut", F.shiftright(low * F.coalesce("cuts", F.lit(1)), ROW_BITS)).drop("cuts")

    span = ["shard", "step", "cut"]
    counts = placed.groupBy(*span).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("step", "cut").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(*span, F.coalesce(before, F.lit(0)).alias("before"))
    numbered = placed.withColumn("number", F.row_number().over(Window.partitionBy(*span).orderBy("_key", "tie")))
    return numbered.join(counts, span).select("row.*", F.col("_size").alias("size"), "shard", (F.col("before") + F.col("number") - 1).cast("long").alias("slot"))
