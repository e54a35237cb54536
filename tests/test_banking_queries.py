"""Golden results of the analytic queries P1-P8 on the sample banking data."""

import pytest

from banking_data import banking_tables
from ledgerflow.plans import banking as P


@pytest.fixture(scope="module")
def results(spark):
    return P.run_all(banking_tables(spark))


def test_p1_posted_checking_totals(results):
    rows = sorted((r.customer_id, r.full_name, r.total_amount, r.txn_count) for r in results["P1"].collect())
    assert rows == [
        (1, "Aarav Shrestha", 12499.0, 3),
        (2, "Nisha Karki", 6499.0, 2),
        (4, "Sita Rai", 3750.0, 3),
        (5, "Bikash Thapa", 4700.0, 2),
        (7, "Prakash Adhikari", 8000.0, 1),
        (8, "Mina Sharma", 3100.0, 1),
    ]


def test_p2_top5(results):
    rows = [(r.customer_id, r.total_amount) for r in results["P2"].collect()]
    assert rows == [(1, 12499.0), (7, 8000.0), (2, 6499.0), (5, 4700.0), (4, 3750.0)]


def test_p3_latest_per_account(results):
    rows = [(r.account_id, r.transaction_id, r.status) for r in results["P3"].collect()]
    assert [(a, t) for a, t, _ in rows] == [
        (1, 3), (2, 5), (3, 8), (4, 11), (5, 14), (6, 16), (7, 18), (8, 19), (9, 20), (10, 21)
    ]
    assert dict((a, s) for a, _, s in rows)[2] == "reversed"
    assert dict((a, s) for a, _, s in rows)[3] == "declined"


def test_p4_merchant_rank(results):
    rows = [(r.customer_id, r.merchant_name, r.total_spend, r.spend_rank) for r in results["P4"].collect()]
    assert rows == [
        (1, "TravelHub", 12000.0, 1), (1, "Mero Online", 7999.0, 2), (1, "Himal Mart", 2500.0, 3),
        (1, "QuickFuel", 2000.0, 4), (2, "Mero Online", 4999.0, 1), (2, "Himal Mart", 1500.0, 2),
        (3, "Skyline Hotel", 40000.0, 1), (3, "TravelHub", 35000.0, 2), (4, "City Pharmacy", 3750.0, 1),
        (5, "Himal Mart", 2600.0, 1), (5, "QuickFuel", 2100.0, 2), (6, "Mero Online", 29000.0, 1),
        (7, "TravelHub", 8000.0, 1), (8, "Himal Mart", 3100.0, 1), (8, "QuickFuel", 1900.0, 2),
    ]


def test_p5_first_12_with_json(results):
    rows = results["P5"].collect()
    assert [r.transaction_id for r in rows] == [1, 6, 2, 3, 12, 13, 14, 4, 9, 7, 5, 15]
    assert [r.channel for r in rows] == [
        "pos", "pos", "web", "pos", "pos", "pos", "pos", "mobile", "pos", "web", "mobile", "pos"
    ]
    assert rows[0].device_id == "DVC-101" and rows[0].ip == "103.10.28.1"


def test_p6_tag_vip(results):
    assert sorted(r.customer_id for r in results["P6"].collect()) == [1, 4, 7]


def test_p7_customers_per_tag(results):
    rows = [(r.tag, r.customer_count) for r in results["P7"].collect()]
    assert rows == [("vip", 3), ("salary", 2), ("student", 2), ("travel", 2), ("risk_high", 1)]


def test_p8_row_counts(results):
    rows = {r.table_name: r.rows for r in results["P8"].collect()}
    assert rows == {"customers": 8, "accounts": 10, "merchants": 6, "transactions": 21}


def test_p1_plan_pushes_filters_and_prunes(spark, tmp_path):
    """Filters reach the Parquet scan and only the needed columns are read."""
    from planutil import plan_text

    tables = banking_tables(spark)
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    t = {n: spark.read.parquet(str(tmp_path / n)) for n in tables}
    plan = plan_text(P.posted_checking_totals(t["customers"], t["accounts"], t["transactions"]))
    assert "EqualTo(status,posted)" in plan
    assert "GreaterThanOrEqual(ts_event" in plan
    assert "EqualTo(account_type,checking)" in plan
    txn_schema = [line for line in plan.splitlines() if "ReadSchema" in line and "ts_event" in line]
    assert txn_schema and "metadata" not in txn_schema[0] and "merchant_id" not in txn_schema[0]
    assert "BatchEvalPython" not in plan and "CartesianProduct" not in plan
