"""Plan checks over every registered query (sf0.001 tables).

No Python UDF evaluation, no cartesian product or nested-loop join, and no
window over a single partition of data (the only single-partition window is
the offsets of surrogate keys, over one row per partition).
"""

import os
import re

import pytest

import __spark_entry__ as E
from ledgerflow.plans.keys import QUERIES
from planutil import plan_text

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")

FORBIDDEN = ["BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_has_no_slow_path(spark, name):
    df = E.queries()[name](spark, SF)
    plan = plan_text(df, "simple")
    for word in FORBIDDEN:
        assert word not in plan, f"{name}: {word}"
    if name not in ("surrogate_keys", "sorted_positions"):
        # a Window whose input is gathered into one partition
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if re.search(r"\bWindow \[", line):
                below = "\n".join(lines[i + 1 : i + 4])
                assert "SinglePartition" not in below, f"{name}: single-partition window"


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    """dedupe / latest-per-key: a partial WindowGroupLimit sits below the exchange."""
    plan = plan_text(E.queries()["dedupe_first"](spark, SF), "simple")
    limits = [m.start() for m in re.finditer(r"WindowGroupLimit .*Partial", plan)]
    exchanges = [m.start() for m in re.finditer(r"Exchange hashpartitioning", plan)]
    assert limits and exchanges and max(limits) > min(exchanges)  # partial limit printed below the exchange


def test_filters_and_pruning_reach_the_scan(spark):
    plan = plan_text(E.queries()["revenue_per_customer"](spark, SF), "formatted")
    assert "EqualTo(o_orderstatus,F)" in plan and "GreaterThanOrEqual(o_orderdate" in plan
    assert "EqualTo(c_mktsegment,BUILDING)" in plan
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double>" in plan
    late = plan_text(E.queries()["late_data_filter"](spark, SF), "formatted")
    assert "GreaterThanOrEqual(ts," in late


def test_selective_join_comes_first_with_a_bloom_filter(spark):
    """With nothing to broadcast, orders meet customers first and a bloom filter reduces line items."""
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        from ledgerflow.plans.keys import revenue_per_customer

        plan = plan_text(revenue_per_customer(spark, SF), "formatted")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "might_contain" in plan and "bloom_filter_agg" in plan
    assert "partial_sum" in plan
    # line items are not aggregated below the join
    assert "keys [1]: [l_orderkey" not in plan


def test_backfill_reads_only_the_missing_time_range(spark, workdir, monkeypatch):
    import datetime as dt

    from ledgerflow.jobs import backfill

    events = spark.read.parquet(f"{SF}/events.parquet")
    seen = []
    real = backfill.interval_totals
    monkeypatch.setattr(backfill, "interval_totals", lambda e, **k: seen.append(e) or real(e, **k))
    args = (spark, events, workdir, dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    assert backfill.run(*args, as_of=dt.datetime(2024, 1, 5)).count() == 3  # ended by then
    plan = plan_text(seen[0], "formatted")
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    assert backfill.run(*args, as_of=dt.datetime(2024, 1, 5)).count() == 0
    assert len(seen) == 1  # nothing missing: no scan
    assert [str(r.run_date) for r in backfill.run(*args, as_of=dt.datetime(2030, 1, 1)).collect()][0] == "2024-01-04"
