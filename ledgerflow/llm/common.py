"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import ensure_checkpoint_dir, scratch_path

#: Words of the contracts: runs of anything but ASCII white space (fixed value).
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Table ``name`` of the input folder (any file system Spark reads)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders of the tables that this process has written and not yet removed.
_written: list[str] = []


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back.

    Cuts the lineage with data on shared storage, so a lost executor costs only
    the tasks it was running; a later stage never recomputes the pass before.
    The table is there until :func:`release` removes it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    _written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written() -> int:
    """How many intermediate tables there are: a mark for :func:`release`."""
    return len(_written)


def release(spark: SparkSession, mark: int = 0) -> int:
    """Remove the intermediate tables written since ``mark``; returns their number.

    For when what was made from them has itself been written: results are lazy and
    read their intermediate tables until then.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _written[mark:]
    del _written[mark:]
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    return len(paths)


#: Rows and bytes that a Python worker gets at a time; texts are long.
BATCH_ROWS, BATCH_BYTES = 1000, 32 << 20


#: Characters of a frame of texts; Python needs some ten bytes for each while it works on them.
FRAME_CHARS = 8 << 20


def frames(batches: Iterator[pd.DataFrame], rows: int, chars: int | None = None) -> Iterator[pd.DataFrame]:
    """The same rows (with a column text) in frames of at most ``rows`` rows and ``chars`` characters,
    whatever the size of Arrow's batches; a longer text is a frame of its own."""
    chars = chars or FRAME_CHARS
    held: list[pd.DataFrame] = []
    n = size = 0
    for batch in batches:
        upto = np.append(0, np.cumsum([len(t) if t else 0 for t in batch["text"]])).astype(np.int64)
        at = 0
        while at < len(batch):
            fits = int(np.searchsorted(upto, upto[at] + chars - size, side="right")) - 1
            end = max(min(fits, at + rows - n, len(batch)), at + 1 if not held else at)
            if end > at:
                held.append(batch.iloc[at:end])
                n, size, at = n + end - at, size + int(upto[end] - upto[at]), end
            if at < len(batch) or n >= rows:
                yield pd.concat(held, ignore_index=True)
                held, n, size = [], 0, 0
    if held:
        yield pd.concat(held, ignore_index=True)


def prepare(spark: SparkSession) -> None:
    """Shared folder (a local one only in tests) and small Arrow batches for the session."""
    ensure_checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def fold(doc_id: Column, n: int) -> Column:
    """crc32(doc_id as text) mod n, the fold of the held-out contracts (null id: fold of '')."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def text_words(text: str | None) -> list[bytes]:
    """UTF-8 words of a text: ``bytes.split`` cuts at exactly x20 and x09-x0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as (row, id, key): all columns in one struct, doc_id, and the hash of the text.

    What an operator adds stands beside the struct, so no column of ``docs`` can
    clash with it; ``select("row.*")`` gives the columns back as they were.
    """
    return docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows stay under the bound, else as it is."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """One row (doc_id, label) per labelled document; repeated label rows: the smallest label."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull())
        .groupBy("doc_id")
        .agg(F.min(F.col(name)).cast("int").alias("label"))
    )
