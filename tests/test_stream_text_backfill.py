"""P11 file stream, P12 text rewrite, P13 backfill."""

import datetime as dt
import os
import shutil

from pyspark.sql import functions as F

from conftest import DATA
from ledgerflow.jobs import backfill, rewrite_text
from ledgerflow.jobs import transactions_load as TL
from ledgerflow.jobs.incremental_load import read_ledger
from ledgerflow.operators import ledger as L
from ledgerflow.streaming import file_load


def test_p11_stream_equals_batch_and_is_exactly_once(spark, workdir):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    shutil.copy(os.path.join(DATA, "transactions.csv"), os.path.join(landing, "part-1.csv"))
    stream_root = os.path.join(workdir, "stream")
    cfg = TL.transactions_config(stream_root, landing)
    ckpt = os.path.join(workdir, "ckpt")
    file_load.run_available(spark, cfg, landing, ckpt)
    batch_root = os.path.join(workdir, "batch")
    TL.run(spark, batch_root, os.path.join(DATA, "transactions.csv"))
    cols = ["txn_id", "account_id", "ts_event", "amount", "currency", "channel", "txn_day"]
    s = sorted(map(tuple, TL.clean_transactions(spark, stream_root).select(cols).collect()))
    b = sorted(map(tuple, TL.clean_transactions(spark, batch_root).select(cols).collect()))
    assert s == b and len(s) == 11
    # second availableNow run on the same checkpoint: nothing new, no new run
    file_load.run_available(spark, cfg, landing, ckpt)
    assert read_ledger(spark, cfg).select("run_id").distinct().count() == 1
    # a new file arrives: processed once, as a new run
    with open(os.path.join(landing, "part-2.csv"), "w") as f:
        f.write("txn_id,account_id,ts_event,amount,currency,channel\nT2001,7,2026-01-05T12:00:00+05:45,50,NPR,web\n")
    file_load.run_available(spark, cfg, landing, ckpt)
    runs = L.current_runs(read_ledger(spark, cfg)).orderBy("run_id").collect()
    assert [(r.run_id, r.status) for r in runs] == [(1, "success"), (2, "success")]
    assert TL.clean_transactions(spark, stream_root).count() == 12


def test_p12_rewrite_lines(spark, workdir):
    out = rewrite_text.run(spark, workdir)
    assert [r.value for r in out.collect()] == ["raw_data=hello_airflow"]
    src = os.path.join(workdir, "in")
    rewrite_text.extract(spark, src, ["hello hello", "no match", "say hello"])
    got = sorted(r.value for r in rewrite_text.transform(spark, src, os.path.join(workdir, "out")).collect())
    assert got == ["hello_airflow hello", "no match", "say hello_airflow"]


def test_p11_older_rows_in_a_later_file_are_loaded(spark, workdir):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    header = "txn_id,account_id,ts_event,amount,currency,channel\n"
    cfg = TL.transactions_config(os.path.join(workdir, "t"), landing)
    with open(os.path.join(landing, "new.csv"), "w") as f:
        f.write(header + "N1,1,2026-02-20T10:00:00Z,10,NPR,pos\n")
    file_load.run_available(spark, cfg, landing, os.path.join(workdir, "ck"))
    with open(os.path.join(landing, "old.csv"), "w") as f:
        f.write("amount,txn_id,account_id,ts_event,currency,channel\n7,O1,2,2026-01-01T10:00:00Z,NPR,web\n")
    file_load.run_available(spark, cfg, landing, os.path.join(workdir, "ck"))
    got = {r.txn_id: float(r.amount) for r in TL.clean_transactions(spark, cfg.root).collect()}
    assert got == {"N1": 10.0, "O1": 7.0}
    runs = L.current_runs(read_ledger(spark, cfg)).orderBy("run_id").collect()
    assert [str(r.watermark)[:10] for r in runs] == ["2026-02-20", "2026-02-20"]  # never moves back
    # a new checkpoint is a new query: its batch 0 is not taken for the first one's
    with open(os.path.join(landing, "third.csv"), "w") as f:
        f.write(header + "T1,1,2026-02-21T10:00:00Z,3,NPR,pos\n")
    file_load.run_available(spark, cfg, landing, os.path.join(workdir, "ck2"))
    assert TL.clean_transactions(spark, cfg.root).count() == 3


def test_p13_backfill(spark, workdir):
    ts = ["2024-01-05 10:00:00", "2024-01-06 12:00:00", "2024-01-08 08:59:59", "2024-01-08 09:00:00",
          "2024-01-09 23:00:00"]
    events = spark.createDataFrame([(t, 1.5) for t in ts], "ts string, value double").select(
        F.col("ts").cast("timestamp_ntz").alias("ts"), "value")
    todo = backfill.run(spark, events, workdir, dt.date(2024, 1, 1), dt.date(2024, 1, 12))
    assert todo.count() == 10  # ten weekdays
    out = {str(r.run_date): r.n_events for r in spark.read.parquet(os.path.join(workdir, "interval_totals")).collect()}
    # Friday's interval runs until Monday 09:00
    assert out == {"2024-01-05": 3, "2024-01-08": 1, "2024-01-09": 1}
    again = backfill.run(spark, events, workdir, dt.date(2024, 1, 1), dt.date(2024, 1, 12))
    assert again.count() == 0
    more = backfill.run(spark, events, workdir, dt.date(2024, 1, 1), dt.date(2024, 1, 16))
    assert [str(r.run_date) for r in more.collect()] == ["2024-01-15", "2024-01-16"]


def test_p11_one_run_per_micro_batch(spark, workdir):
    landing = os.path.join(workdir, "landing")
    os.makedirs(landing)
    header = "txn_id,account_id,ts_event,amount,currency,channel\n"
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write(header + "S1,1,2026-01-01T10:00:00+00:00,10,NPR,pos\nS2,1,2026-01-01T11:00:00+00:00,11,USD,pos\n")
    with open(os.path.join(landing, "b.csv"), "w") as f:
        f.write(header + "S3,2,2026-01-01T12:00:00+00:00,12,NPR,web\nS1,1,2026-01-01T10:30:00+00:00,15,NPR,pos\n")
    cfg = TL.transactions_config(os.path.join(workdir, "t"), landing)
    file_load.run_available(spark, cfg, landing, os.path.join(workdir, "ck"), max_files_per_trigger=1)
    runs = L.current_runs(read_ledger(spark, cfg)).orderBy("run_id").collect()
    assert [(r.run_id, r.status, r.rows_read, r.bad_rows) for r in runs] == [(1, "success", 2, 1), (2, "success", 2, 0)]
    got = {r.txn_id: (float(r.amount), r.last_run_id) for r in TL.clean_transactions(spark, cfg.root).collect()}
    assert got == {"S1": (15.0, 2), "S3": (12.0, 2)}
