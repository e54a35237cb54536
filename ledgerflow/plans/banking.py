"""The analytic queries P1-P8 over the banking schema (customers, accounts,
merchants, transactions), composed from the library's operators.

Each function takes DataFrames, so the same plan runs on Parquet tables, a
catalog, or the hand-typed fixture rows of the tests.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ledgerflow.functions.scalars import json_fields
from ledgerflow.operators import relational as R

# The reporting window of P1/P2 (half-open, local +05:45 offset).
WINDOW_START = "2026-01-01 00:00:00+05:45"
WINDOW_END = "2026-01-06 00:00:00+05:45"


def posted_checking_totals(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    lo: str = WINDOW_START,
    hi: str = WINDOW_END,
) -> DataFrame:
    """Total amount and count of posted transactions on checking accounts per customer."""
    txn = R.where_between(R.where_equals(transactions, status="posted"), "ts_event", lo, hi)
    acc = R.where_equals(accounts, account_type="checking").select("account_id", "customer_id")
    joined = R.join_chain(
        txn.select("account_id", "amount"),
        (acc, "account_id"),
        (customers.select("customer_id", "full_name"), "customer_id"),
    )
    return R.grouped_totals(joined, ["customer_id", "full_name"], "amount")


def top_customers(
    customers: DataFrame,
    accounts: DataFrame,
    transactions: DataFrame,
    k: int = 5,
    lo: str = WINDOW_START,
    hi: str = WINDOW_END,
) -> DataFrame:
    """The ``k`` customers with the largest P1 totals (ties broken by id)."""
    totals = posted_checking_totals(customers, accounts, transactions, lo, hi)
    return R.top_k(totals, k, [R.desc("total_amount"), R.asc("customer_id")])


def latest_transaction_per_account(transactions: DataFrame) -> DataFrame:
    """Newest transaction of every account, all statuses."""
    latest = R.latest_per_key(
        transactions,
        ["account_id"],
        ["ts_event", "transaction_id"],
        ["transaction_id", "ts_event", "amount", "status"],
    )
    return R.sort_total(latest, [R.asc("account_id")])


def merchant_spend_rank(
    customers: DataFrame, accounts: DataFrame, transactions: DataFrame, merchants: DataFrame
) -> DataFrame:
    """Posted spend per (customer, merchant), ranked within each customer."""
    txn = R.where_equals(transactions, status="posted").select("account_id", "merchant_id", "amount")
    joined = R.join_chain(
        txn,
        (accounts.select("account_id", "customer_id"), "account_id"),
        (customers.select("customer_id", "full_name"), "customer_id"),
        (merchants.select("merchant_id", "merchant_name"), "merchant_id"),
    )
    spend = R.grouped_totals(
        joined, ["customer_id", "full_name", "merchant_name"], "amount", "total_spend", None
    )
    ranked = R.rank_within(spend, ["customer_id"], "total_spend", "spend_rank")
    return R.sort_total(ranked, [R.asc("customer_id"), R.asc("spend_rank"), R.desc("total_spend")])


def first_transactions_with_channel(transactions: DataFrame, k: int = 12) -> DataFrame:
    """P5: the first ``k`` transactions by time with JSON metadata fields."""
    first = R.top_k(
        transactions.select("transaction_id", "ts_event", "amount", "metadata"),
        k,
        [R.asc("ts_event"), R.asc("transaction_id")],
    )
    # Parsed after the top-k, so only k JSON documents are read.
    return first.select(
        "transaction_id", "ts_event", "amount", *json_fields("metadata", ["channel", "device_id", "ip"])
    )


def customers_with_tag(customers: DataFrame, tag: str = "vip") -> DataFrame:
    """Customers whose tags contain ``tag``."""
    return R.where_contains_all(customers, "tags", [tag]).select("customer_id", "full_name", "tags")


def customers_per_tag(customers: DataFrame) -> DataFrame:
    """Number of customers per tag, most common first."""
    counts = R.explode_counts(customers, "tags", "tag", "customer_count")
    return R.sort_total(counts, [R.desc("customer_count"), R.asc("tag")])


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``count(*)`` of every table, labelled."""
    return R.labelled_counts(tables, "table_name", "rows")


def run_all(tables: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All of P1-P8 over a mapping with keys customers/accounts/merchants/transactions."""
    c, a, m, t = (tables[k] for k in ("customers", "accounts", "merchants", "transactions"))
    return {
        "P1": posted_checking_totals(c, a, t),
        "P2": top_customers(c, a, t),
        "P3": latest_transaction_per_account(t),
        "P4": merchant_spend_rank(c, a, t, m),
        "P5": first_transactions_with_channel(t),
        "P6": customers_with_tag(c),
        "P7": customers_per_tag(c),
        "P8": table_row_counts({"customers": c, "accounts": a, "merchants": m, "transactions": t}),
    }
