"""P10: customer CSV -> staging (replace) -> customer dimension (upsert).

The dimension keeps each customer's first ``created_at``; a key delivered
twice in the feed takes its last row; customers absent from the feed stay.
A load writes only its own customers as ``run_id=<r>``; the dimension is the
newest successful run's row per customer with the earliest ``created_at``, and
the ledger success event commits a load, so a failed one changes nothing.
Rows whose id is no integer go to the rejects with a reason, and are counted.
The feed is parsed once: its typed rows are stored as ``dim_feed/run_id=<r>``, and
staging, rejects, dimension and counters are made from them.
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.scalars import message, row_to_json, split_name, to_int
from ledgerflow.operators import ledger as L
from ledgerflow.operators.merge import POSITION, dedupe, insert_if_absent
from ledgerflow.schemas import DIM_CUSTOMER, ETL_RUNS, REJECTED_CUSTOMERS, STAGING_CUSTOMERS
from ledgerflow.operators.quality import MSG_VALIDATION
from ledgerflow.sources.claims import claim_run_id
from ledgerflow.sources.files import read_csv_strings, replace_table, require_columns
from ledgerflow.sources.runs import RUN, append_run, newest_per_key, run_rows
from ledgerflow.sources.tables import count_tables, read_or_empty

REQUIRED = ["customer_id", "full_name", "email"]

# The seed row of the staging table.
SEED_ROW = (1, "Seed User", "seed.user@example.com")


def _paths(root: str) -> dict[str, str]:
    return {t: os.path.join(root, t) for t in ("staging_customers", "dim_customer", "dim_rejects", "dim_runs", "dim_feed")}


def seed_staging(spark: SparkSession, root: str) -> DataFrame:
    """M4: ``INSERT ... ON CONFLICT (customer_id) DO NOTHING`` of the seed row."""
    p = _paths(root)
    current = read_or_empty(spark, p["staging_customers"], STAGING_CUSTOMERS)
    seed = spark.createDataFrame([SEED_ROW], STAGING_CUSTOMERS)
    merged = insert_if_absent(current, seed, ["customer_id"]).checkpoint(eager=True)
    replace_table(merged, p["staging_customers"])
    return spark.read.parquet(p["staging_customers"])


def current_dimension(spark: SparkSession, root: str) -> DataFrame:
    """The committed dimension: newest row per customer, earliest ``created_at``."""
    p = _paths(root)
    ledger = read_or_empty(spark, p["dim_runs"], ETL_RUNS)
    rows = run_rows(spark, p["dim_customer"], DIM_CUSTOMER, ledger)
    return newest_per_key(rows, "customer_id", ["created_at"]).select(*DIM_CUSTOMER.fieldNames())


def rejected_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rejected feed rows of committed loads: original row, reason, time, run."""
    p = _paths(root)
    return run_rows(spark, p["dim_rejects"], REJECTED_CUSTOMERS, read_or_empty(spark, p["dim_runs"], ETL_RUNS))


def run(spark: SparkSession, root: str, csv_path: str, now: dt.datetime | None = None) -> DataFrame:
    """Load the feed; returns the table counts ``(table_name, rows)``."""
    p = _paths(root)
    feed = read_csv_strings(spark, csv_path, position=True)
    require_columns(feed, REQUIRED)
    typed = feed.select(
        to_int("customer_id").alias("customer_id"), "full_name", "email", *POSITION,
        row_to_json(REQUIRED).alias("raw_row"), F.col("customer_id").alias("_raw_id"),
    )
    next_id, _ = L.ledger_state(read_or_empty(spark, p["dim_runs"], ETL_RUNS))
    run_id = claim_run_id(spark, os.path.join(root, "dim"), next_id)
    started = dt.datetime.now(dt.timezone.utc)
    L.append_event(spark, p["dim_runs"], run_id, 1, L.RUNNING, csv_path, at=started)
    try:
        append_run(typed, p["dim_feed"], run_id)
        kept = T.StructType([*typed.schema.fields, T.StructField(RUN, T.LongType())])
        typed = read_or_empty(spark, p["dim_feed"], kept).where(F.col(RUN) == run_id)
        good = typed.where(F.col("customer_id").isNotNull())
        replace_table(good.select("customer_id", "full_name", "email"), p["staging_customers"])
        created = F.lit(now).cast("timestamp") if now is not None else F.current_timestamp()
        rejects = typed.where(F.col("customer_id").isNull()).select(
            "raw_row", message(MSG_VALIDATION.format("customer_id"), "_raw_id").alias("error"), created.alias("created_at")
        )
        append_run(rejects, p["dim_rejects"], run_id)
        # Last delivery of a key wins (file position taken at the feed scan).
        latest = dedupe(good, ["customer_id"], POSITION, "last", ["full_name", "email"])
        first, last = split_name("full_name")
        src = latest.select(
            "customer_id", first.alias("first_name"), last.alias("last_name"), "email", created.alias("created_at")
        )
        append_run(src, p["dim_customer"], run_id)
        counts = typed.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_id").isNull()).alias("bad")).first()
        n, bad = counts["n"], counts["bad"]
        L.append_event(spark, p["dim_runs"], run_id, 2, L.SUCCESS, csv_path, n, n - bad, bad, "OK", started_at=started)
    except Exception as exc:
        L.append_event(spark, p["dim_runs"], run_id, 2, L.FAILED, csv_path, message=str(exc), started_at=started)
        raise
    staging = spark.read.parquet(p["staging_customers"])
    return count_tables({"staging_customers": staging, "dim_customer": current_dimension(spark, root)})


def main(argv: list[str] | None = None) -> int:
    """``python -m ledgerflow.jobs.customer_dim --root R --csv F``: load, then print the counts."""
    import argparse

    from ledgerflow.session import build_session

    ap = argparse.ArgumentParser(description="Customer feed -> staging -> customer dimension")
    ap.add_argument("--root", required=True)
    ap.add_argument("--csv", required=True)
    ap.add_argument("--seed", action="store_true", help="insert the seed staging row first")
    args = ap.parse_args(argv)
    spark = build_session(app_name="customer_dim")
    if args.seed:
        seed_staging(spark, args.root)
    run(spark, args.root, args.csv).show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
