"""File-arrival load as a Structured Streaming query.

The original waits for a file to appear and then processes it. Here the
landing folder is a streaming file source: each file is taken once, tracked
by the query's checkpoint; ``trigger(availableNow=True)`` processes what has
arrived and stops (a scheduled run), a processing-time trigger keeps waiting.

Each micro-batch is one load run of :mod:`ledgerflow.jobs.incremental_load`
through ``foreachBatch``: the stream decides which files are new, and the run
reads those files like a batch feed, so fields are taken by each file's header
and line breaks in quotes are handled alike. A file is delivered once, so a run
has no cutoff: rows older than the watermark are loaded too.
A retried batch is idempotent: its run id is found in the ledger by
``(landing folder, streaming query id, batch id)``; a batch that already
succeeded is skipped, otherwise its run id is reused and its partitions are
overwritten. A new checkpoint is a new query id, so its batches are new runs.
"""

from __future__ import annotations

import time

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.jobs.incremental_load import LoadConfig, read_ledger, run_load
from ledgerflow.operators import ledger as L
from ledgerflow.sources.claims import make_folder


def batch_source(landing: str, query_id: str, batch_id: int) -> str:
    return f"{landing}#query={query_id}&batch={batch_id}"


def _run_id_for(spark: SparkSession, cfg: LoadConfig, source: str) -> tuple[int | None, bool]:
    """The run id of a batch that was tried before, and whether it succeeded; a new batch has none yet."""
    own = read_ledger(spark, cfg).where(F.col("source_path") == source)
    mine = L.current_runs(own).select("run_id", "status").collect()
    if mine:  # at most a few rows: the events of one batch
        done = any(r["status"] == L.SUCCESS for r in mine)
        return int(mine[0]["run_id"]), done
    return None, False


def file_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The paths of arriving files, one row per file.

    ``binaryFile`` lists a file as one row; without its ``content`` column the files
    are not opened at all, so finding out which files are new reads no data.
    """
    schema = "path string, modificationTime timestamp, length long, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return reader.load(landing).select(F.col("path").alias("file"))


def start(
    spark: SparkSession,
    cfg: LoadConfig,
    landing: str,
    checkpoint: str,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
):
    """Start the stream; returns the ``StreamingQuery``."""

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # Structured Streaming names the running query in the batch's local properties.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        source = batch_source(landing, query_id, batch_id)
        run_id, done = _run_id_for(batch.sparkSession, cfg, source)
        if done:
            return
        files = sorted(r["file"] for r in batch.collect())  # one row per file of the batch
        batch_cfg = LoadConfig(**{**cfg.__dict__, "source_path": source})
        run_load(batch.sparkSession, batch_cfg, run_id=run_id, files=files, use_cutoff=False)

    writer = (
        file_stream(spark, landing, max_files_per_trigger)
        .writeStream.foreachBatch(each_batch)
        .option("checkpointLocation", checkpoint)
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def run_available(
    spark: SparkSession, cfg: LoadConfig, landing: str, checkpoint: str, max_files_per_trigger: int | None = None
) -> None:
    """Process every file that has arrived, then stop (one run per micro-batch)."""
    q = start(spark, cfg, landing, checkpoint, available_now=True, max_files_per_trigger=max_files_per_trigger)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def wait_for_files(
    spark: SparkSession,
    cfg: LoadConfig,
    landing: str,
    checkpoint: str,
    timeout: float = 300.0,
    poke: float = 10.0,
    max_files_per_trigger: int | None = None,
) -> int:
    """Keep looking for files every ``poke`` seconds, load what arrives, then stop.

    The stream runs on a processing-time trigger and is stopped once it has loaded
    something and found nothing more at its latest look. No file within ``timeout``
    seconds of the start is an error. Returns the number of batches loaded. Defaults
    are the original sensor's (fixed values: 10 and 300 seconds).
    """
    try:  # the stream lists the folder, so it has to exist before the first file
        spark.read.format("binaryFile").load(landing)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        make_folder(spark, landing)
    deadline = time.monotonic() + timeout
    q = start(spark, cfg, landing, checkpoint, False, f"{poke} seconds", max_files_per_trigger)
    loaded, seen = 0, None
    try:
        while True:
            if q.awaitTermination(min(poke, 1.0) / 4):  # raises what a batch raised
                break
            last = q.lastProgress
            if last is not None and (now := (last["batchId"], last["timestamp"])) != seen:
                seen = now
                if last["numInputRows"] > 0:
                    loaded = last["batchId"] + 1
                elif loaded and not q.status["isTriggerActive"]:
                    break
            if loaded and not q.status["isDataAvailable"] and not q.status["isTriggerActive"]:
                break
            if not loaded and not q.status["isTriggerActive"] and time.monotonic() > deadline:
                raise TimeoutError(f"no file in {landing} within {timeout:g} seconds")
    finally:
        q.stop()
    return loaded


def dedupe_within_watermark(stream: DataFrame, key: str, ts_col: str, delay: str = "24 hours") -> DataFrame:
    """Alternative for append-only feeds: drop repeated keys seen within the
    event-time watermark (state is bounded by the delay). Late rows that are
    not duplicates are dropped too, and an emitted row is never replaced, so
    the ``foreachBatch`` upsert above is the default."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([key])
