"""Validation rules of the transactions feed on the edge rows of FIXTURES §3."""

import pytest
from pyspark.sql import functions as F

from ledgerflow.jobs.transactions_load import transactions_spec
from ledgerflow.operators.quality import bad_rows, good_rows, load_counters, validate
from ledgerflow.schemas import TRANSACTIONS_FEED_COLUMNS

BASE = {"txn_id": "T1", "account_id": "5", "ts_event": "2026-01-01T09:10:00+05:45",
        "amount": "100", "currency": "NPR", "channel": "pos"}


def check(spark, **overrides):
    row = {**BASE, **overrides}
    df = spark.createDataFrame([tuple(row[c] for c in TRANSACTIONS_FEED_COLUMNS)],
                               ", ".join(f"{c} string" for c in TRANSACTIONS_FEED_COLUMNS))
    return validate(df, transactions_spec()).first()


@pytest.mark.parametrize(
    "overrides, error_prefix",
    [
        ({"txn_id": "  "}, "txn_id is empty"),
        ({"txn_id": None}, "txn_id is empty"),
        ({"account_id": "abc"}, "validation error"),
        ({"account_id": "5.0"}, "validation error"),
        ({"account_id": "99999999999"}, "validation error"),
        ({"amount": "0"}, "amount must be > 0"),
        ({"amount": "-1"}, "amount must be > 0"),
        ({"amount": "NaN"}, "validation error"),
        ({"amount": "inf"}, "validation error"),
        ({"amount": "99999999999"}, "validation error"),
        ({"amount": "2500d"}, "validation error"),
        ({"currency": "USD"}, "unsupported currency: USD"),
        ({"channel": "atm"}, "unsupported channel: atm"),
        ({"ts_event": ""}, "validation error"),
        ({"ts_event": "yesterday"}, "validation error"),
    ],
)
def test_bad_rows(spark, overrides, error_prefix):
    r = check(spark, **overrides)
    assert r["error"] is not None and r["error"].startswith(error_prefix), r["error"]


def test_good_rows_are_normalised(spark):
    r = check(spark, account_id=" 5 ", currency="npr ", channel=" WEB", amount="0.005")
    assert r["error"] is None
    assert (r["account_id"], r["currency"], r["channel"], str(r["amount"])) == (5, "NPR", "web", "0.01")


def test_tiny_amount_passes_then_rounds_to_zero(spark):
    r = check(spark, amount="0.004")
    assert r["error"] is None and str(r["amount"]) == "0.00"


def test_first_failing_rule_wins(spark):
    r = check(spark, txn_id="", amount="-5", currency="USD")
    assert r["error"] == "txn_id is empty"
    r = check(spark, amount="-5", currency="USD")
    assert r["error"] == "amount must be > 0"


def test_raw_row_is_original_text(spark):
    r = check(spark, currency=" usd")
    assert r["error"] == "unsupported currency: USD"
    assert '"currency":" usd"' in r["raw_row"]


def test_split_and_counters_from_one_scan(spark):
    rows = [("T1", "1", BASE["ts_event"], "5", "NPR", "pos"), ("T2", "x", BASE["ts_event"], "5", "NPR", "pos"),
            ("T3", "1", BASE["ts_event"], "5", "EUR", "pos")]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TRANSACTIONS_FEED_COLUMNS))
    v = validate(df, transactions_spec())
    assert good_rows(v).count() == 1
    assert bad_rows(v).count() == 2
    c = load_counters(v).first()
    assert (c.rows_read, c.rows_loaded, c.bad_rows) == (3, 1, 2)
    assert c.rows_loaded + c.bad_rows == c.rows_read
