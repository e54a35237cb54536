"""The incremental CSV transactions load, configured for the bank feed."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.jobs.incremental_load import LoadConfig, RunResult, read_clean, run_load
from ledgerflow.operators.quality import FeedSpec
from ledgerflow.schemas import CLEAN_TRANSACTIONS, TRANSACTIONS_FEED_COLUMNS

# Fixed values of the transactions feed: accepted currencies and channels,
# the job name under which the watermark is kept, and the default lookback.
ALLOWED_CURRENCY = ["NPR"]
ALLOWED_CHANNELS = ["pos", "web", "mobile"]
JOB_NAME = "CSV_transaction_etl_job"
LOOKBACK_HOURS = 24


def transactions_spec() -> FeedSpec:
    """Rules in order: txn_id blank; account_id / amount unparseable; amount <= 0;
    currency; channel; then ts_event unparseable; amount out of NUMERIC(12,2) range."""
    return FeedSpec(
        id_col="txn_id",
        int_cols=["account_id"],
        number_col="amount",
        ts_col="ts_event",
        domains=[("currency", ALLOWED_CURRENCY, "upper"), ("channel", ALLOWED_CHANNELS, "lower")],
        min_exclusive=0.0,
        ts_type="timestamp",
        raw_columns=TRANSACTIONS_FEED_COLUMNS,
    )


def transactions_config(
    root: str,
    csv_path: str,
    lookback_hours: int = LOOKBACK_HOURS,
    on_duplicate: str = "ignore",
) -> LoadConfig:
    return LoadConfig(
        root=root,
        source_path=csv_path,
        spec=transactions_spec(),
        key="txn_id",
        job_name=JOB_NAME,
        day_col="txn_day",
        lookback_hours=lookback_hours,
        on_duplicate=on_duplicate,
        feed_columns=list(TRANSACTIONS_FEED_COLUMNS),
    )


def run(spark: SparkSession, root: str, csv_path: str, **kwargs) -> RunResult:
    """One run of the load; raises if the run fails (after recording it)."""
    return run_load(spark, transactions_config(root, csv_path, **kwargs))


def clean_transactions(spark: SparkSession, root: str) -> DataFrame:
    """The committed clean table (``clean_transactions``)."""
    cfg = transactions_config(root, os.devnull)
    return read_clean(spark, cfg, CLEAN_TRANSACTIONS)


def main(argv: list[str] | None = None) -> int:
    """``python -m ledgerflow.jobs.transactions_load --root R --csv F``: one run, then the preview."""
    import argparse

    from ledgerflow.jobs.incremental_load import preview_run
    from ledgerflow.session import build_session

    ap = argparse.ArgumentParser(description="Incremental load of a transactions CSV feed")
    ap.add_argument("--root", required=True, help="namespace folder of the load tables (shared storage)")
    ap.add_argument("--csv", required=True, help="feed file or folder")
    ap.add_argument("--lookback-hours", type=int, default=LOOKBACK_HOURS)
    ap.add_argument("--on-duplicate", choices=["ignore", "error"], default="ignore")
    args = ap.parse_args(argv)
    spark = build_session(app_name="transactions_load")
    result = run(
        spark, args.root, args.csv,
        lookback_hours=args.lookback_hours, on_duplicate=args.on_duplicate,
    )
    summary, first = preview_run(
        spark, transactions_config(args.root, args.csv), result.run_id, clean_transactions(spark, args.root)
    )
    summary.show(truncate=False)
    first.show(truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
