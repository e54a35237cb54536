"""The run ledger: an append-only table of run events.

Starting a run appends a ``running`` event; finishing appends the final one
(``success``/``failed``) with counters and the new watermark. The current
state of a run is its newest event (latest per key). Data written by a run is
visible to readers only when that newest event is ``success``: this takes the
place of the database transaction of the original job, and it also keeps the
rows of failed runs on storage for diagnosis.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.relational import latest_per_key
from ledgerflow.schemas import ETL_RUNS

# Run statuses.
RUNNING = "running"
SUCCESS = "success"
FAILED = "failed"


@dataclass(frozen=True)
class Totals:
    """Rows, distinct keys and non-positive rows of the clean table over ``runs`` successful runs."""

    runs: int
    rows: int
    keys: int
    non_positive: int


def append_event(spark: SparkSession, path: str, run_id: int, seq: int, *args, **kwargs) -> None:
    """Add an event (see :func:`run_event`) to the ledger table.

    Every event goes to a folder of its own run and number: writers of different
    runs share no folder, so one's commit never removes another's unfinished files.
    """
    event = run_event(spark, run_id, seq, *args, **kwargs).drop("run_id", "event_seq")
    event.write.mode("append").parquet(os.path.join(path, f"run_id={run_id}", f"event_seq={seq}"))


def run_event(
    spark: SparkSession,
    run_id: int,
    seq: int,
    status: str,
    source_path: str,
    rows_read: int = 0,
    rows_loaded: int = 0,
    bad_rows: int = 0,
    message: str | None = None,
    watermark: dt.datetime | None = None,
    at: dt.datetime | None = None,
    started_at: dt.datetime | None = None,
    totals: Totals | None = None,
) -> DataFrame:
    """M5/M6: one ledger event row (``start_run`` is ``seq=1, status=running``).

    The final event repeats ``started_at`` and adds ``finished_at``, so the
    newest event alone is the whole run record. A success event may carry the
    clean table's ``totals``, this run included.
    """
    at = at or dt.datetime.now(dt.timezone.utc)
    running = status == RUNNING
    row = (
        int(run_id), int(seq), at, status, source_path, int(rows_read), int(rows_loaded),
        int(bad_rows), message, watermark, at if running else started_at, None if running else at,
        *((totals.runs, totals.rows, totals.keys, totals.non_positive) if totals else (None,) * 4),
    )
    # one row of literals: no Python worker, one partition, one small file
    return spark.range(0, 1, 1, 1).select(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, ETL_RUNS.fields, strict=True)])


def current_runs(ledger: DataFrame) -> DataFrame:
    """M6 as a view: the newest event of every run.

    Newest by event time (when the ledger records it), then by sequence
    number: a retried run (a stream
    batch re-executed under its run id) appends new events that supersede the
    failed attempt's, even with the same sequence number.
    """
    cols = [c for c in ledger.columns if c != "run_id"]
    order = ["event_at", "event_seq"] if "event_at" in ledger.columns else ["event_seq"]
    return latest_per_key(ledger, ["run_id"], order, cols)


def successful_run_ids(ledger: DataFrame) -> DataFrame:
    return current_runs(ledger).where(F.col("status") == SUCCESS).select("run_id")


def visible(df: DataFrame, ledger: DataFrame, run_col: str = "run_id") -> DataFrame:
    """Rows written by runs whose newest ledger event is ``success``.

    A left semi join with the successful run ids (one row per run). AQE turns
    it into a broadcast when the measured size is small, which it is for any
    realistic number of runs; otherwise it stays a shuffle join.
    """
    ok = successful_run_ids(ledger).withColumnRenamed("run_id", run_col)
    return df.join(ok, run_col, "left_semi")


def next_run_id(ledger: DataFrame) -> int:
    """S11 for runs: ``max(run_id) + 1`` (one writer per job)."""
    row = ledger.agg(F.max("run_id").alias("m")).first()
    return 1 if row is None or row["m"] is None else int(row["m"]) + 1



def ledger_state(ledger: DataFrame) -> tuple[int, object]:
    """``(next run id, last committed watermark)`` from one aggregate over the ledger."""
    cur = current_runs(ledger)
    ok = (F.col("status") == SUCCESS) & F.col("watermark").isNotNull()
    row = cur.agg(
        F.max("run_id").alias("m"),
        F.max_by(F.when(ok, F.col("watermark")), F.when(ok, F.col("run_id"))).alias("wm"),
    ).first()
    if row is None or row["m"] is None:
        return 1, None
    return int(row["m"]) + 1, row["wm"]


def covering_totals(ledger: DataFrame, run_id: int) -> Totals | None:
    """The totals that cover all successful runs, if all of them precede ``run_id``; else None.

    A run that commits while another is at work makes the other's totals cover too few
    runs; the next run then finds none that cover all, and counts the table anew.
    """
    ok = current_runs(ledger).where(F.col("status") == SUCCESS)
    known = F.struct("visible_runs", "clean_rows", "clean_keys", "clean_non_positive")
    row = ok.agg(
        F.count(F.lit(1)).alias("runs"), F.max("run_id").alias("newest"), F.max(F.when(F.col("clean_rows").isNotNull(), known)).alias("last")
    ).first()
    if row["runs"] == 0:
        return Totals(0, 0, 0, 0)
    if row["newest"] >= run_id or row["last"] is None or row["last"]["visible_runs"] != row["runs"]:
        return None
    return Totals(*(int(x) for x in row["last"]))
