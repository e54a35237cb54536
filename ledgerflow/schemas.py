"""Table schemas of the banking data model and the load tables."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


_TYPES = {
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "STRING": T.StringType(),
    "TIMESTAMP": T.TimestampType(),
    "DATE": T.DateType(),
    "DOUBLE": T.DoubleType(),
    "BOOLEAN": T.BooleanType(),
    "DECIMAL(12,2)": MONEY,
    "ARRAY<STRING>": T.ArrayType(T.StringType()),
}


def _schema(columns: str) -> T.StructType:
    """``"name TYPE, name TYPE"`` with the handful of types above (no session needed)."""
    fields = []
    for item in columns.split(", "):
        name, type_name = item.split(" ", 1)
        fields.append(T.StructField(name, _TYPES[type_name], True))
    return T.StructType(fields)


CUSTOMERS = _schema(
    "customer_id INT, full_name STRING, email STRING, city STRING, "
    "created_at TIMESTAMP, tags ARRAY<STRING>"
)
ACCOUNTS = _schema(
    "account_id INT, customer_id INT, account_type STRING, opened_at TIMESTAMP, status STRING"
)
MERCHANTS = _schema("merchant_id INT, merchant_name STRING, mcc STRING, city STRING")
TRANSACTIONS = _schema(
    "transaction_id BIGINT, account_id INT, merchant_id INT, ts_event TIMESTAMP, "
    "amount DECIMAL(12,2), currency STRING, status STRING, metadata STRING"
)

# Load tables of the incremental transactions job.
ETL_RUNS = _schema(
    "run_id BIGINT, event_seq INT, event_at TIMESTAMP, status STRING, source_path STRING, "
    "rows_read BIGINT, rows_loaded BIGINT, bad_rows BIGINT, message STRING, "
    "watermark TIMESTAMP, started_at TIMESTAMP, finished_at TIMESTAMP, "
    # totals of the clean table with this run, and how many successful runs they cover
    "visible_runs BIGINT, clean_rows BIGINT, clean_keys BIGINT, clean_non_positive BIGINT"
)
RAW_TRANSACTIONS = _schema(
    "id BIGINT, txn_id STRING, account_id INT, ts_event TIMESTAMP, amount DECIMAL(12,2), "
    "currency STRING, channel STRING, ingested_at TIMESTAMP, run_id BIGINT"
)
BAD_TRANSACTIONS = _schema(
    "id BIGINT, raw_row STRING, error STRING, created_at TIMESTAMP, run_id BIGINT"
)
CLEAN_TRANSACTIONS = _schema(
    "txn_id STRING, account_id INT, ts_event TIMESTAMP, amount DECIMAL(12,2), "
    "currency STRING, channel STRING, txn_day DATE, last_run_id BIGINT"
)
DQ_RESULTS = _schema(
    "id BIGINT, check_name STRING, passed BOOLEAN, metric DOUBLE, details STRING, "
    "created_at TIMESTAMP, run_id BIGINT"
)

# Customer dimension job.
STAGING_CUSTOMERS = _schema("customer_id INT, full_name STRING, email STRING")
DIM_CUSTOMER = _schema(
    "customer_id INT, first_name STRING, last_name STRING, email STRING, created_at TIMESTAMP"
)
REJECTED_CUSTOMERS = _schema("raw_row STRING, error STRING, created_at TIMESTAMP")

# The transactions feed: every field arrives as text.
TRANSACTIONS_FEED_COLUMNS = ["txn_id", "account_id", "ts_event", "amount", "currency", "channel"]
CUSTOMER_FEED_COLUMNS = ["customer_id", "full_name", "email"]
