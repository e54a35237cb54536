"""P9 incremental load and P10 dimension load, end to end on the sample feeds."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import DATA
from ledgerflow.jobs import customer_dim as CD
from ledgerflow.jobs import transactions_load as TL
from ledgerflow.jobs.incremental_load import read_ledger, visible_table
from ledgerflow.operators import ledger as L
from ledgerflow.schemas import BAD_TRANSACTIONS

FEED = os.path.join(DATA, "transactions.csv")


def test_p9_run_twice(spark, workdir):
    r1 = TL.run(spark, workdir, FEED)
    assert (r1.rows_read, r1.bad_rows, r1.rows_loaded) == (16, 4, 11)
    assert r1.cutoff is None and r1.watermark == dt.datetime(2026, 1, 5, 4, 20)
    clean = TL.clean_transactions(spark, workdir)
    assert clean.count() == 11 and clean.where("last_run_id = 1").count() == 11
    bad = visible_table(spark, TL.transactions_config(workdir, FEED), "bad", BAD_TRANSACTIONS)
    assert {r.error for r in bad.collect()} == {"unsupported currency: USD"}

    r2 = TL.run(spark, workdir, FEED)
    assert r2.cutoff == dt.datetime(2026, 1, 4, 4, 20)
    assert (r2.rows_read, r2.bad_rows, r2.rows_loaded) == (2, 1, 1)
    assert r2.watermark == dt.datetime(2026, 1, 5, 4, 20)
    clean2 = TL.clean_transactions(spark, workdir)
    assert clean2.count() == 11
    assert [r.txn_id for r in clean2.where("last_run_id = 2").collect()] == ["T1014"]
    per_day = {str(r.txn_day): r["count"] for r in clean2.groupBy("txn_day").count().collect()}
    assert per_day == {"2026-01-01": 3, "2026-01-02": 5, "2026-01-03": 1, "2026-01-04": 1, "2026-01-05": 1}
    # re-running changes no clean row other than last_run_id
    cols = [c for c in clean.columns if c != "last_run_id"]
    assert sorted(map(tuple, clean.select(cols).collect())) == sorted(map(tuple, clean2.select(cols).collect()))
    dq = spark.read.parquet(os.path.join(workdir, "dq"))
    assert dq.where(~F.col("passed")).count() == 0 and dq.count() == 8


def test_p9_duplicates_as_errors_fail_and_leave_nothing_visible(spark, workdir):
    with pytest.raises(RuntimeError, match="duplicate"):
        TL.run(spark, workdir, FEED, on_duplicate="error")
    runs = L.current_runs(read_ledger(spark, TL.transactions_config(workdir, FEED))).collect()
    assert [r.status for r in runs] == ["failed"]
    assert TL.clean_transactions(spark, workdir).count() == 0


def test_p9_dq_failure_is_recorded_and_invisible(spark, workdir, tmp_path):
    feed = tmp_path / "tiny.csv"
    feed.write_text("txn_id,account_id,ts_event,amount,currency,channel\n"
                    "A1,1,2026-01-01T09:10:00+05:45,0.004,NPR,pos\n"
                    "A2,1,2026-01-01T09:11:00+05:45,5,NPR,pos\n")
    with pytest.raises(RuntimeError, match="no_non_positive_amounts_in_clean"):
        TL.run(spark, workdir, str(feed))
    cfg = TL.transactions_config(workdir, str(feed))
    assert L.current_runs(read_ledger(spark, cfg)).first().status == "failed"
    assert TL.clean_transactions(spark, workdir).count() == 0
    # the failed run's DQ rows stay on storage for diagnosis
    from ledgerflow.schemas import DQ_RESULTS
    assert visible_table(spark, cfg, "dq", DQ_RESULTS, include_failed=True).count() == 4
    assert visible_table(spark, cfg, "dq", DQ_RESULTS).count() == 0
    # the watermark did not move: a later good run starts without cutoff
    good = tmp_path / "good.csv"
    good.write_text("txn_id,account_id,ts_event,amount,currency,channel\nA3,1,2026-01-01T09:10:00+05:45,7,NPR,pos\n")
    r = TL.run(spark, workdir, str(good))
    assert r.cutoff is None and r.run_id == 2
    assert [x.txn_id for x in TL.clean_transactions(spark, workdir).collect()] == ["A3"]


def test_p9_upsert_moves_rows_between_runs(spark, workdir, tmp_path):
    f1 = tmp_path / "f1.csv"
    f1.write_text("txn_id,account_id,ts_event,amount,currency,channel\n"
                  "X1,1,2026-01-01T10:00:00+00:00,10,NPR,pos\nX2,2,2026-01-01T11:00:00+00:00,20,NPR,web\n")
    TL.run(spark, workdir, str(f1), lookback_hours=100000)
    f2 = tmp_path / "f2.csv"
    f2.write_text("txn_id,account_id,ts_event,amount,currency,channel\n"
                  "X2,3,2026-01-02T11:00:00+00:00,25,NPR,mobile\nX3,1,2026-01-02T12:00:00+00:00,30,npr,POS\n")
    TL.run(spark, workdir, str(f2), lookback_hours=100000)
    got = {r.txn_id: (r.account_id, float(r.amount), r.channel, str(r.txn_day), r.last_run_id)
           for r in TL.clean_transactions(spark, workdir).collect()}
    assert got == {
        "X1": (1, 10.0, "pos", "2026-01-01", 1),
        "X2": (3, 25.0, "mobile", "2026-01-02", 2),
        "X3": (1, 30.0, "pos", "2026-01-02", 2),
    }


def test_p10_customer_dimension(spark, workdir, tmp_path):
    CD.seed_staging(spark, workdir)
    counts = {r.table_name: r.rows for r in CD.run(spark, workdir, os.path.join(DATA, "customers.csv"),
                                                     now=dt.datetime(2026, 1, 1)).collect()}
    assert counts == {"staging_customers": 4, "dim_customer": 4}
    dim = {r.customer_id: (r.first_name, r.last_name) for r in CD.current_dimension(spark, workdir).collect()}
    assert dim == {101: ("Aarav", "Shrestha"), 102: ("Sarita", "Karki"), 103: ("Prakash", "Gurung"), 104: ("Nisha", "Rai")}
    feed = tmp_path / "c2.csv"
    feed.write_text("customer_id,full_name,email\n101,Aarav Shrestha,changed@example.com\n"
                    "105,  A   B  C ,a@b\n105,Last Wins,z@z\n")
    CD.run(spark, workdir, str(feed), now=dt.datetime(2026, 2, 1))
    dim = {r.customer_id: r for r in CD.current_dimension(spark, workdir).collect()}
    assert len(dim) == 5
    assert dim[101].email == "changed@example.com" and dim[101].created_at == dt.datetime(2026, 1, 1)
    assert (dim[105].first_name, dim[105].last_name) == ("Last", "Wins")


def test_p10_missing_column(spark, workdir, tmp_path):
    feed = tmp_path / "bad.csv"
    feed.write_text("customer_id,full_name\n1,X Y\n")
    with pytest.raises(ValueError, match="email"):
        CD.run(spark, workdir, str(feed))


def test_p9_preview(spark, workdir):
    from ledgerflow.jobs.incremental_load import preview_run

    r = TL.run(spark, workdir, FEED)
    cfg = TL.transactions_config(workdir, FEED)
    summary, first = preview_run(spark, cfg, r.run_id, TL.clean_transactions(spark, workdir))
    s = summary.first()
    assert (s.status, s.rows_read, s.rows_loaded, s.bad_rows, s.message) == ("success", 16, 11, 4, "OK")
    assert [x.txn_id for x in first.collect()][:3] == ["T1001", "T1012", "T1002"]
    assert first.count() == 10


def test_p9_second_run_adds_only_its_rows(spark, workdir, tmp_path):
    """200 keys, then 5 of them again: 200 distinct rows, and DQ counts the whole table."""
    from ledgerflow.jobs.incremental_load import visible_table
    from ledgerflow.schemas import DQ_RESULTS

    header = "txn_id,account_id,ts_event,amount,currency,channel\n"
    first, second = tmp_path / "f1.csv", tmp_path / "f2.csv"
    row = "K{0},1,2026-01-01T10:00:00Z,{1},NPR,pos\n"
    first.write_text(header + "".join(row.format(i, 10) for i in range(200)))
    second.write_text(header + "".join(row.format(i, 99) for i in range(5)))
    for f in (first, second):
        TL.run(spark, workdir, str(f))
    clean = TL.clean_transactions(spark, workdir).collect()
    assert len(clean) == len({r.txn_id for r in clean}) == 200
    assert sorted(r.txn_id for r in clean if r.last_run_id == 2) == [f"K{i}" for i in range(5)]
    assert {float(r.amount) for r in clean if r.last_run_id == 2} == {99.0}
    written = spark.read.parquet(os.path.join(workdir, "clean")).groupBy("run_id").count().collect()
    assert {r.run_id: r["count"] for r in written} == {1: 200, 2: 5}
    dq = visible_table(spark, TL.transactions_config(workdir, ""), "dq", DQ_RESULTS)
    details = {r.run_id: r.details for r in dq.where("check_name = 'no_duplicates_in_clean_transactions'").collect()}
    assert details == {1: "Total rows: 200, Distinct txn_id: 200", 2: "Total rows: 200, Distinct txn_id: 200"}


def test_rewrite_stores_the_current_rows(spark, workdir):
    from ledgerflow.sources.runs import rewrite

    TL.run(spark, workdir, FEED)
    clean = TL.clean_transactions(spark, workdir)
    rewrite(clean, os.path.join(workdir, "clean_plain"))
    plain = spark.read.parquet(os.path.join(workdir, "clean_plain"))
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, clean.collect()))


def test_p9_message_is_kept_whole(spark, workdir, tmp_path):
    with pytest.raises(Exception):
        TL.run(spark, workdir, str(tmp_path / ("x" * 100) / "absent.csv"))
    run = L.current_runs(read_ledger(spark, TL.transactions_config(workdir, ""))).first()
    assert run.status == "failed" and "absent.csv" in run.message
    assert run.started_at <= run.finished_at


def test_p9_headers_by_name_and_quoted_line_breaks(spark, workdir, tmp_path):
    import dataclasses

    from ledgerflow.jobs.incremental_load import run_load

    feed = tmp_path / "feed"
    feed.mkdir()
    (feed / "a.csv").write_text("account_id,txn_id,channel,currency,amount,ts_event\n42,A1,pos,NPR,9,2026-01-01T10:00:00Z\n")
    (feed / "b.csv").write_text('txn_id,account_id,ts_event,amount,currency,channel,note\nA2,7,2026-01-01T10:00:00Z,5,NPR,"web","two\nlines"\n')
    (feed / "c.csv").write_text("txn_id,account_id\nA3,7\n")
    (feed / "d.csv").write_text("")
    cfg = dataclasses.replace(TL.transactions_config(workdir, str(feed)), multi_line=True)
    r = run_load(spark, cfg)
    assert (r.rows_read, r.rows_loaded, r.bad_rows) == (3, 2, 1)
    got = {x.txn_id: (x.account_id, float(x.amount), x.channel) for x in TL.clean_transactions(spark, workdir).collect()}
    assert got == {"A1": (42, 9.0, "pos"), "A2": (7, 5.0, "web")}


def test_p10_rejects_are_kept_and_counted(spark, workdir, tmp_path):
    feed = tmp_path / "c.csv"
    feed.write_text("customer_id,full_name,email\nabc,X Y,a@b\n7.0,Z,c@d\n5,Aarav\u00a0Shrestha, e@f \n", encoding="utf-8")
    counts = {r.table_name: r.rows for r in CD.run(spark, workdir, str(feed)).collect()}
    assert counts == {"staging_customers": 1, "dim_customer": 1}
    r = CD.current_dimension(spark, workdir).first()
    assert (r.first_name, r.last_name) == ("Aarav", "Shrestha")
    errors = sorted(x.error for x in CD.rejected_rows(spark, workdir).collect())
    assert errors == ["validation error: invalid customer_id: 7.0", "validation error: invalid customer_id: abc"]
    run = L.current_runs(spark.read.parquet(os.path.join(workdir, "dim_runs"))).first()
    assert (run.rows_read, run.rows_loaded, run.bad_rows) == (3, 1, 2)
