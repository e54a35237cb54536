"""One key holding a third of all rows: results stay whole and exact, and the
plans reduce the hot key on the map side (checked against brute force)."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import quality as Q
from ledgerflow.operators import relational as R
from ledgerflow.operators.merge import dedupe
from planutil import plan_text

N = 30000


@pytest.fixture(scope="module")
def skewed(spark):
    # key 0 holds a third of the rows; the rest spread over 5000 keys
    df = spark.range(0, N, numPartitions=6).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000 + 1).alias("k"),
        (F.col("id") % 97 + F.lit(0.25)).alias("amount"),
    )
    return df, [(r.id, r.k, r.amount) for r in df.collect()]


def test_grouped_totals_hot_key(spark, skewed):
    df, rows = skewed
    out = {r.k: (r.total_amount, r.txn_count) for r in R.grouped_totals(df, ["k"], "amount").collect()}
    counts = Counter(k for _, k, _ in rows)
    sums: dict = {}
    for _, k, a in rows:
        sums[k] = sums.get(k, 0) + round(a * 100)
    assert len(out) == len(counts)
    assert out[0] == (sums[0] / 100, counts[0]) and counts[0] == N // 3
    plan = plan_text(R.grouped_totals(df, ["k"], "amount"), "simple")
    assert re.search(r"HashAggregate\(keys=\[k#\d+L\], functions=\[partial_sum", plan)


def test_dedupe_hot_key(spark, skewed):
    df, rows = skewed
    out = {r.k: r.id for r in dedupe(df, ["k"], ["id"], "last", ["id", "amount"]).collect()}
    expected: dict = {}
    for i, k, _ in rows:
        expected[k] = max(expected.get(k, -1), i)
    assert out == expected
    plan = plan_text(dedupe(df, ["k"], ["id"], "last", ["id", "amount"]), "simple")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_foreign_key_hot_value(spark, skewed):
    df, rows = skewed
    parent = spark.range(1, 5001).select(F.col("id").alias("pk"))  # key 0 has no parent
    rep = Q.foreign_key_report(df, "t", "k", parent, "pk").first()
    assert rep.violations == sum(1 for _, k, _ in rows if k == 0) == N // 3


def test_explode_counts_hot_element(spark):
    df = spark.range(0, N, numPartitions=6).select(
        F.array(F.lit("hot"), (F.col("id") % 50).cast("string")).alias("tags")
    )
    out = {r.tag: r.n for r in R.explode_counts(df, "tags", "tag", "n").collect()}
    assert out["hot"] == N and sum(out.values()) == 2 * N


def test_latest_per_key_hot_key(spark, skewed):
    df, rows = skewed
    out = {r.k: r.id for r in R.latest_per_key(df, ["k"], ["amount", "id"], ["amount", "id"]).collect()}
    best: dict = {}
    for i, k, a in rows:
        if k not in best or (a, i) > best[k]:
            best[k] = (a, i)
    assert out == {k: v[1] for k, v in best.items()}
