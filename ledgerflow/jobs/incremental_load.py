"""Incremental load of a text feed into a clean keyed table.

Steps of one run (mirroring the original job, but on Spark):

1. claim a run id on shared storage (max + 1, or the next free one if another
   load has taken it) and append a ``running`` event to the run ledger;
2. watermark = newest successful run's watermark; cutoff = watermark - lookback;
3. scan the feed once (file position taken at the scan), drop rows before the
   cutoff (unparseable times pass), validate in one select;
4. quarantine bad rows (``bad/run_id=R``), keep the first row per key in file
   order (``ON CONFLICT DO NOTHING``) or fail on duplicates, write
   ``raw/run_id=R``;
5. write raw(R) with its computed columns as ``clean/run_id=R``: the clean table
   is the newest row per key among successful runs, so this is the upsert;
6. DQ checks on the whole clean table as if the run had succeeded, recorded in
   ``dq/run_id=R``; a failure appends a ``failed`` event and raises. The counts
   they need (rows, distinct keys, non-positive rows) are kept run by run: the last
   success event's totals, plus those of clean(R), less those of the rows that
   clean(R) replaces (:func:`replaced_totals`). Only where no totals cover all
   committed runs (see ``covering_totals``), or with ``dq="full"``, is the whole
   table counted;
7. append the ``success`` event carrying counters, totals and the new watermark
   (max event time of raw(R), unchanged when nothing was loaded). That single
   append is the commit point.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.operators import ledger as L
from ledgerflow.operators.incremental import compute_cutoff, late_data_filter
from ledgerflow.operators.merge import POSITION, dedupe
from ledgerflow.operators.quality import (
    ERROR,
    RAW_ROW,
    SURPLUS,
    FeedSpec,
    dq_report,
    unique_report,
    validate,
)
from ledgerflow.schemas import ETL_RUNS
from ledgerflow.sources.claims import claim_run_id
from ledgerflow.sources.files import read_csv_strings
from ledgerflow.sources.runs import RUN, append_run, newest_per_key, run_rows
from ledgerflow.sources.tables import read_or_empty


@dataclass
class LoadConfig:
    root: str
    source_path: str
    spec: FeedSpec
    key: str
    job_name: str
    day_col: str = "txn_day"
    lookback_hours: int = 24
    on_duplicate: str = "ignore"  # "ignore" (insert ... do nothing) or "error" (bulk copy)
    feed_columns: list[str] = field(default_factory=list)
    multi_line: bool = False  # quoted fields may hold line breaks (files are then not split)
    dq: str = "delta"  # "delta" (totals kept run by run) or "full" (count the whole table)
    sketch: bool = False  # store a mergeable sketch of each run's keys (see distinct_keys)

    def path(self, table: str) -> str:
        return os.path.join(self.root, table)


@dataclass
class RunResult:
    run_id: int
    status: str
    rows_read: int
    rows_loaded: int
    bad_rows: int
    cutoff: object
    watermark: object
    message: str | None = None


#: Logarithm of the number of registers of a key sketch (4 KB a run).
SKETCH_BITS = 12
# Fixed value: the message of a failed check.
MSG_DQ_FAILED = "Data Quality checks failed: {}"


def read_ledger(spark: SparkSession, cfg: LoadConfig) -> DataFrame:
    return read_or_empty(spark, cfg.path("etl_runs"), ETL_RUNS)


def replaced_rows(
    spark: SparkSession, cfg: LoadConfig, ledger: DataFrame, source: DataFrame, bounds: tuple[object, object]
) -> DataFrame:
    """The committed rows whose key the run delivers again (key, number column).

    Rows of earlier runs meet the run's keys in a left semi join before anything is
    shuffled by key: small key sets are broadcast, larger ones reach the scan side as
    a bloom filter, and ``bounds`` (least and greatest key of the run) skip row groups.
    So the exchange carries the rows that are replaced, not the table.
    """
    schema = T.StructType([f for f in source.schema.fields if f.name in (cfg.key, cfg.spec.number_col)])
    lo, hi = bounds
    key_type = schema[cfg.key].dataType
    rows = run_rows(spark, cfg.path("clean"), schema, ledger)
    rows = rows.where((F.col(cfg.key) >= F.lit(lo).cast(key_type)) & (F.col(cfg.key) <= F.lit(hi).cast(key_type)))
    return newest_per_key(rows.join(source.select(cfg.key), cfg.key, "left_semi"), cfg.key)


def _delta_totals(
    spark: SparkSession, cfg: LoadConfig, ledger: DataFrame, base: L.Totals, source: DataFrame, stats: Row
) -> L.Totals:
    """Totals of the clean table with this run: ``base`` + the run's own - those of the rows it replaces."""
    rows = keys = non_positive = 0
    if base.runs and stats["n"]:
        old = replaced_rows(spark, cfg, ledger, source, (stats["lo"], stats["hi"])).agg(
            F.count(F.lit(1)).alias("n"), F.count_distinct(cfg.key).alias("keys"), F.count_if(F.col(cfg.spec.number_col) <= 0).alias("bad")
        ).first()
        rows, keys, non_positive = old["n"], old["keys"], old["bad"]
    return L.Totals(
        base.runs + 1, base.rows + stats["n"] - rows, base.keys + stats["keys"] - keys, base.non_positive + stats["bad"] - non_positive
    )


def _counted_totals(clean: DataFrame, cfg: LoadConfig, ledger: DataFrame) -> L.Totals:
    """The same totals by a pass over the whole clean table, this run included."""
    c = clean.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct(cfg.key).alias("keys"), F.count_if(F.col(cfg.spec.number_col) <= 0).alias("bad")
    ).first()
    return L.Totals(L.successful_run_ids(ledger).count() + 1, c["n"], c["keys"], c["bad"])


def read_clean(
    spark: SparkSession, cfg: LoadConfig, schema: T.StructType | None = None, ledger: DataFrame | None = None
) -> DataFrame:
    """The committed clean table: the newest successful run's row of every key.

    Without ``schema`` the column types are taken from the Parquet footers.
    """
    return _clean_rows(spark, cfg, read_ledger(spark, cfg) if ledger is None else ledger, schema)


def _clean_rows(
    spark: SparkSession, cfg: LoadConfig, ledger: DataFrame, schema: T.StructType | None = None, staged_run: int | None = None
) -> DataFrame:
    if schema is None:
        found = spark.read.parquet(cfg.path("clean")).schema
        schema = T.StructType([f for f in found.fields if f.name != RUN])
    return newest_per_key(run_rows(spark, cfg.path("clean"), schema, ledger, staged_run), cfg.key)


def visible_table(spark: SparkSession, cfg: LoadConfig, table: str, schema: T.StructType, include_failed: bool = False) -> DataFrame:
    """raw / bad / dq rows of committed runs (J6); failed runs on request."""
    full = T.StructType(list(schema.fields) + [T.StructField("run_id", T.LongType())])
    df = read_or_empty(spark, cfg.path(table), full)
    return df if include_failed else L.visible(df, read_ledger(spark, cfg), "run_id")


def run_load(
    spark: SparkSession,
    cfg: LoadConfig,
    feed: DataFrame | None = None,
    run_id: int | None = None,
    files: Sequence[str] | None = None,
    use_cutoff: bool = True,
) -> RunResult:
    """Execute one run; returns its counters. Raises when the run fails.

    ``files`` names the feed's files (default: ``source_path``). A source that
    delivers every file once reads without cutoff (``use_cutoff=False``): the
    cutoff only spares re-reading rows that an earlier run has seen.
    """
    next_id, watermark = L.ledger_state(read_ledger(spark, cfg))
    if run_id is None:
        run_id = claim_run_id(spark, cfg.root, next_id)
    started = dt.datetime.now(dt.timezone.utc)
    runs = cfg.path("etl_runs")
    L.append_event(spark, runs, run_id, 1, L.RUNNING, cfg.source_path, at=started)
    cutoff = compute_cutoff(watermark, cfg.lookback_hours) if use_cutoff else None
    rows_read = rows_loaded = bad = 0
    validated = None
    try:
        if feed is None:
            feed = read_csv_strings(
                spark, list(files) if files is not None else cfg.source_path, cfg.feed_columns or None, cfg.multi_line, True, SURPLUS
            )
        spec = cfg.spec
        spec_extra = FeedSpec(**{**spec.__dict__, "extra_columns": tuple(POSITION)})
        if SURPLUS in feed.columns:
            spec_extra.surplus_col = SURPLUS
        scanned = late_data_filter(feed, spec.ts_col, cutoff, spec.ts_type)
        validated = validate(scanned, spec_extra).persist(StorageLevel.DISK_ONLY)
        now = F.current_timestamp()
        row_id = F.monotonically_increasing_id().alias("id")  # unique within the run

        # Quarantine: every bad row with its original text and first failing rule.
        bad_df = validated.where(F.col(ERROR).isNotNull()).select(
            row_id, F.col(RAW_ROW).alias("raw_row"), F.col(ERROR).alias("error"), now.alias("created_at")
        )
        append_run(bad_df, cfg.path("bad"), run_id)

        good = validated.where(F.col(ERROR).isNull()).drop(ERROR, RAW_ROW)
        payload = [c for c in good.columns if c not in POSITION and c != cfg.key]
        if cfg.on_duplicate == "error":
            dups = unique_report(good, "raw", [cfg.key]).first()["violations"]
            if dups:
                raise RuntimeError(f"duplicate key value violates unique constraint ({cfg.key}): {dups} keys")
        kept = dedupe(good, [cfg.key], POSITION, "first", payload).select(cfg.key, *payload)
        append_run(kept.select(row_id, "*", now.alias("ingested_at")), cfg.path("raw"), run_id)

        counters = validated.agg(
            F.count(F.lit(1)).alias("read"), F.count_if(F.col(ERROR).isNotNull()).alias("bad")
        ).first()
        rows_read, bad = int(counters["read"]), int(counters["bad"])
        validated.unpersist()

        # Transform: raw(R) -> clean(R), the run's rows of the clean table.
        raw_schema = T.StructType([*kept.schema.fields, T.StructField(RUN, T.LongType())])
        raw_r = read_or_empty(spark, cfg.path("raw"), raw_schema).where(F.col(RUN) == run_id)
        source = raw_r.select(
            cfg.key, *payload,
            F.to_date(F.col(spec.ts_col)).alias(cfg.day_col),
            F.lit(run_id).cast("bigint").alias("last_run_id"),
        )
        stats = source.agg(
            F.count(F.lit(1)).alias("n"), F.max(spec.ts_col).alias("max_ts"), F.count_distinct(cfg.key).alias("keys"),
            F.count_if(F.col(spec.number_col) <= 0).alias("bad"), F.min(cfg.key).alias("lo"), F.max(cfg.key).alias("hi"),
        ).first()
        rows_loaded, run_max = int(stats["n"]), stats["max_ts"]
        append_run(source, cfg.path("clean"), run_id)
        if cfg.sketch:
            append_run(source.agg(F.hll_sketch_agg(cfg.key, SKETCH_BITS).alias("keys")), cfg.path("sketches"), run_id)

        # DQ on the whole clean table, this run and whatever others committed meanwhile included.
        ledger = read_ledger(spark, cfg)
        base = L.covering_totals(ledger, run_id) if cfg.dq == "delta" else None
        influenced = rows_loaded
        if base is not None:
            totals = _delta_totals(spark, cfg, ledger, base, source, stats)
        else:
            staged = _clean_rows(spark, cfg, ledger, source.schema, run_id)
            totals = _counted_totals(staged, cfg, ledger)
            influenced = staged.where(F.col("last_run_id") == run_id).count()
        counts = {
            "loaded": rows_loaded, "total": totals.rows, "distinct_total": totals.keys, "influenced": influenced, "non_positive": totals.non_positive,
        }
        dq = dq_report(spark.range(0, 1, 1, 1).select(*[F.lit(n).cast("bigint").alias(c) for c, n in counts.items()]), run_id)
        append_run(dq.select(row_id, "*", F.current_timestamp().alias("created_at")), cfg.path("dq"), run_id)
        dq_rows = dq.collect()  # four rows, of literals
        failed = [r["check_name"] for r in dq_rows if not r["passed"]]
        if failed:
            raise RuntimeError(MSG_DQ_FAILED.format(", ".join(failed)))

        new_wm = max((w for w in (run_max, None if use_cutoff else watermark) if w is not None), default=watermark)
        L.append_event(
            spark, runs, run_id, 2, L.SUCCESS, cfg.source_path, rows_read, rows_loaded, bad, "OK", new_wm, started_at=started, totals=totals
        )
        return RunResult(run_id, L.SUCCESS, rows_read, rows_loaded, bad, cutoff, new_wm)
    except Exception as exc:
        if validated is not None:
            validated.unpersist()
        L.append_event(spark, runs, run_id, 2, L.FAILED, cfg.source_path, rows_read, rows_loaded, bad, str(exc), started_at=started)
        raise


def distinct_keys(spark: SparkSession, cfg: LoadConfig) -> DataFrame:
    """A5 by sketches: runs and estimated distinct keys of all committed runs, in one row.

    Each run stores one sketch of its own keys (``sketch=True``); the sketches of the
    visible runs are united, so no key is read again, however long the history is.
    Standard error about 1.04 / sqrt(2 ** :data:`SKETCH_BITS`), 1.6 %.
    """
    schema = T.StructType([T.StructField("keys", T.BinaryType())])
    rows = run_rows(spark, cfg.path("sketches"), schema, read_ledger(spark, cfg))
    return rows.agg(F.count(F.lit(1)).alias("runs"), F.hll_sketch_estimate(F.hll_union_agg("keys")).alias("estimate"))


def preview_run(spark: SparkSession, cfg: LoadConfig, run_id: int, clean: DataFrame, k: int = 10) -> tuple[DataFrame, DataFrame]:
    """The run's current ledger row and the first ``k`` clean rows by event time."""
    summary = L.current_runs(read_ledger(spark, cfg)).where(F.col("run_id") == run_id)
    first = clean.orderBy(F.col(cfg.spec.ts_col).asc_nulls_last(), F.col(cfg.key)).limit(k)
    return summary, first
