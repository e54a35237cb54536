"""Event-time dedupe as a job (I8): Structured Streaming state in RocksDB, a file sink,
and restarts from the checkpoint.

For append-only feeds that deliver a key several times within ``delay`` of event
time. State holds one entry per key until the watermark (newest event time seen
less ``delay``) passes the key's time plus ``delay``, so it is bounded by the rate of
keys, not by history, and lies in RocksDB on disk, not in the executor's heap; its
changes go to the checkpoint folder on shared storage with every batch. Rows older
than the watermark are dropped, repeated or not, and an emitted row is never
replaced: where that matters, use the upsert of :mod:`ledgerflow.streaming.file_load`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.streaming.file_load import dedupe_within_watermark

#: State in RocksDB, with only the changes of a batch written to the checkpoint.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def run_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    key: str,
    ts_col: str,
    out: str,
    checkpoint: str,
    delay: str,
    max_files_per_trigger: int | None = None,
) -> None:
    """Append the new keys of all files that have arrived since the last call to ``out``, then stop.

    A call that died is made good by the next: its files are in the checkpoint's
    offset log, and the sink's own log names the files of finished batches only.
    """
    before = {k: spark.conf.get(k, None) for k in STATE_CONF}
    try:
        for k, v in STATE_CONF.items():
            spark.conf.set(k, v)
        reader = spark.readStream.schema(schema).option("header", True).option("escape", '"')
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
        kept = dedupe_within_watermark(reader.csv(landing).where(F.col(ts_col).isNotNull()), key, ts_col, delay)
        q = (
            kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()


def read_out(spark: SparkSession, out: str) -> DataFrame:
    """Rows of finished batches (Spark reads the sink's log, not the folder)."""
    return spark.read.parquet(out)
