"""Totals by deltas, claimed run ids, headers in one job, surplus fields, waiting, bucketed tables, variants, defaults."""

import dataclasses
import json
import os
import random
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import scalars as X
from ledgerflow.jobs import incremental_load as IL
from ledgerflow.jobs import transactions_load as TL
from ledgerflow.operators import ledger as L
from ledgerflow.operators.quality import SURPLUS
from ledgerflow.sources import claims, files, runs, tables
from ledgerflow.streaming import file_load
from planutil import plan_text

HEADER = "txn_id,account_id,ts_event,amount,currency,channel\n"


def feed(path, keys, amount=10, day=1):
    path.write_text(HEADER + "".join(f"{k},1,2026-01-{day:02d}T10:00:00Z,{amount},NPR,pos\n" for k in keys))
    return str(path)


def jobs_of(spark, fn):
    group = f"jobs-{time.time()}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        out = fn()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


# --- Q2-Q5 P9: totals by deltas ----------------------------------------------------------

def totals(spark, cfg):
    rows = L.current_runs(IL.read_ledger(spark, cfg)).orderBy("run_id").collect()
    return {r.run_id: (r.visible_runs, r.clean_rows, r.clean_keys, r.clean_non_positive) for r in rows if r.status == "success"}


@pytest.mark.parametrize("seed", [1, 2])
def test_delta_totals_equal_a_recount(spark, workdir, tmp_path, seed, monkeypatch):
    rng = random.Random(seed)
    counted = []
    real = IL._counted_totals
    monkeypatch.setattr(IL, "_counted_totals", lambda *a: counted.append(1) or real(*a))
    for i in range(4):
        f = feed(tmp_path / f"f{i}.csv", rng.sample([f"K{n}" for n in range(60)], 25), amount=10 + i)
        TL.run(spark, workdir, f, lookback_hours=10**6)
        cfg = TL.transactions_config(workdir, f)
        clean = TL.clean_transactions(spark, workdir)
        n = clean.count()
        assert totals(spark, cfg)[i + 1] == (i + 1, n, clean.select("txn_id").distinct().count(), clean.where("amount <= 0").count())
    assert not counted  # no run counted the whole table
    full = dataclasses.replace(TL.transactions_config(workdir, f, lookback_hours=10**6), dq="full")
    IL.run_load(spark, full)
    assert counted and totals(spark, full)[5] == (5, n, n, 0)


def test_delta_counts_what_a_replaced_row_had(spark, workdir, tmp_path, monkeypatch):
    """Non-positive rows of earlier runs leave the totals when a later run replaces them."""
    cfg = TL.transactions_config(workdir, feed(tmp_path / "a.csv", ["A", "B", "C"]), lookback_hours=10**6)
    IL.run_load(spark, cfg)
    old = IL._clean_rows(spark, cfg, IL.read_ledger(spark, cfg))
    bad = old.withColumn("amount", F.lit(0).cast("decimal(12,2)"))
    files.append_partitioned(bad.withColumn("run_id", F.lit(1).cast("bigint")), cfg.path("clean"), ["run_id"])  # as if checks had been lax
    source = spark.createDataFrame([("B", 5), ("D", 6)], "txn_id string, amount int").withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    stats = source.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("txn_id").alias("keys"), F.count_if(F.col("amount") <= 0).alias("bad"),
        F.min("txn_id").alias("lo"), F.max("txn_id").alias("hi"),
    ).first()
    got = IL._delta_totals(spark, cfg, IL.read_ledger(spark, cfg), L.Totals(1, 3, 3, 3), source, stats)
    assert got == L.Totals(2, 4, 4, 2)


def test_totals_that_do_not_cover_all_runs_are_not_used(spark):
    def ledger(*events):
        out = events[0]
        for e in events[1:]:
            out = out.unionByName(e)
        return out

    one = L.run_event(spark, 1, 2, L.SUCCESS, "f", totals=L.Totals(1, 5, 5, 0))
    two = L.run_event(spark, 2, 2, L.SUCCESS, "f", totals=L.Totals(2, 8, 8, 1))
    beside = L.run_event(spark, 2, 2, L.SUCCESS, "f", totals=L.Totals(1, 4, 4, 0))  # committed without seeing run 1
    old = L.run_event(spark, 2, 2, L.SUCCESS, "f")  # written before totals were kept
    failed = L.run_event(spark, 3, 2, L.FAILED, "f")
    assert L.covering_totals(ledger(one, two, failed), 4) == L.Totals(2, 8, 8, 1)
    assert L.covering_totals(ledger(one, beside), 3) is None and L.covering_totals(ledger(one, old), 3) is None
    assert L.covering_totals(ledger(one, two), 2) is None  # a newer run has committed already
    assert L.covering_totals(ledger(failed), 4) == L.Totals(0, 0, 0, 0)


def test_delta_plan_exchanges_only_replaced_rows(spark, workdir, tmp_path):
    """Large key sets: rows of earlier runs pass a bloom filter and the run's key bounds before any exchange."""
    cfg = TL.transactions_config(workdir, feed(tmp_path / "a.csv", [f"K{n}" for n in range(50)]), lookback_hours=10**6)
    IL.run_load(spark, cfg)
    source = spark.read.parquet(cfg.path("clean")).where("run_id = 1").select("txn_id", "amount")
    keep = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
    }
    before = {k: spark.conf.get(k, None) for k in keep}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        plan = plan_text(IL.replaced_rows(spark, cfg, IL.read_ledger(spark, cfg), source, ("K10", "K20")), "formatted")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "might_contain" in plan and "GreaterThanOrEqual(txn_id,K10)" in plan and "LessThanOrEqual(txn_id,K20)" in plan
    small = plan_text(IL.replaced_rows(spark, cfg, IL.read_ledger(spark, cfg), source, ("K10", "K20")), "simple")
    assert "BroadcastHashJoin" in small and "LeftSemi" in small
    below = small[small.index("LeftSemi") :]  # the history's scan, below the join with the run's keys, has no exchange by key
    assert "hashpartitioning(txn_id" not in below.split("Scan parquet")[0]


# --- M5 S11: claimed run ids ------------------------------------------------------------

def test_claims_are_exclusive(spark, workdir):
    start = threading.Barrier(8)

    def claim(_):
        start.wait()
        return claims.claim_run_id(spark, workdir, 3)

    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(claim, range(8))) == list(range(3, 11))
    assert claims.claim_run_id(spark, workdir, 1) == 1 and claims.claim_run_id(spark, workdir, 1) == 2 and claims.claim_run_id(spark, workdir, 1) == 11


def test_two_loads_at_once_lose_nothing(spark, workdir, tmp_path):
    cfgs = [
        TL.transactions_config(workdir, feed(tmp_path / f"{name}.csv", [f"{name}{n}" for n in range(30)] + ["BOTH"], amount), lookback_hours=10**6)
        for name, amount in (("P", 5), ("Q", 7))
    ]
    with ThreadPoolExecutor(2) as pool:
        done = list(pool.map(lambda c: IL.run_load(spark, c, use_cutoff=False), cfgs))
    assert sorted(r.run_id for r in done) == [1, 2]
    newest = max(done, key=lambda r: r.run_id)
    clean = {r.txn_id: r for r in TL.clean_transactions(spark, workdir).collect()}
    assert len(clean) == 61 and clean["BOTH"].last_run_id == newest.run_id
    # whatever the two recorded, the next run's totals are right
    IL.run_load(spark, TL.transactions_config(workdir, feed(tmp_path / "r.csv", ["P1", "NEW"]), lookback_hours=10**6), use_cutoff=False)
    assert totals(spark, cfgs[0])[3] == (3, 62, 62, 0)


def test_other_file_systems_create_without_overwriting(spark, workdir):
    """A path that is not of the plain local scheme takes Hadoop's create."""
    path = f"viewfs://claims{workdir}/claim"
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.claims.link./tmp", "file:///tmp")
    if not workdir.startswith("/tmp/"):
        pytest.skip("temporary folder elsewhere")
    assert claims.create_if_absent(spark, path) and not claims.create_if_absent(spark, path)


# --- S1 S14: headers, surplus ---------------------------------------------------------------

def test_headers_of_many_files_take_as_many_jobs_as_of_few(spark, tmp_path):
    def landing(n):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for i in range(n):
            (folder / f"f{i}.csv").write_text(("a,b\n" if i % 2 else "\n  \nb,c\n") + f"{i},x\n" * 3)
        return str(folder)

    few, jobs_few = jobs_of(spark, lambda: files.csv_headers(spark, landing(50)))
    many, jobs_many = jobs_of(spark, lambda: files.csv_headers(spark, landing(200)))
    assert jobs_many == jobs_few <= 4
    assert {k: len(v) for k, v in many.items()} == {("a", "b"): 100, ("b", "c"): 100} and set(few) == set(many)


def test_header_names_and_odd_files(spark, tmp_path):
    (tmp_path / "a b.csv").write_text('\ufeffid,"full, name",,id\n1,x,y,2\n', encoding="utf-8")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n")
    (tmp_path / "only.csv").write_text("id\n")
    assert files.header_names('\ufeffid,"full, name",,id') == ("_c0", "full, name", "_c2", "id")
    got = files.read_csv_strings(spark, str(tmp_path))
    assert got.columns == ["_c0", "full, name", "_c2", "id"]
    assert [tuple(r) for r in got.collect()] == [("1", "x", "y", "2")]
    assert files.read_csv_strings(spark, str(tmp_path / "empty.csv"), ["id"], position=True, surplus="more").count() == 0


def test_surplus_and_short_rows(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text('a,b,c\n1,2,3\n4,5,6,7\n8,"x,""y""",9,"p ""q"", r",,z\n10,11\n"l,1","",2\n12\n13,14,15,\n')
    rows = [tuple(r) for r in files.read_csv_strings(spark, str(p), surplus="more").collect()]
    assert rows == [
        ("1", "2", "3", None), ("4", "5", "6", ["7"]), ("8", 'x,"y"', "9", ['p "q", r', "", "z"]), ("10", "11", None, None),
        ("l,1", None, "2", None), ("12", None, None, None), ("13", "14", "15", [""]),
    ]
    assert [tuple(r) for r in files.read_csv_strings(spark, str(p), ["c", "a"], surplus="more").collect()][1] == ("6", "4", ["7"])


def test_surplus_is_quarantined_with_its_row(spark, workdir, tmp_path):
    from ledgerflow.schemas import BAD_TRANSACTIONS

    f = tmp_path / "f.csv"
    f.write_text(HEADER + "S1,1,2026-01-01T10:00:00Z,10,NPR,pos,more,\"and, more\"\nS2,1,2026-01-01T10:00:00Z,10,USD,pos,more,\"and, more\"\nS3,1,2026-01-01T10:00:00Z,-1\n")
    r = TL.run(spark, workdir, str(f))
    assert (r.rows_read, r.rows_loaded, r.bad_rows) == (3, 1, 2)
    assert SURPLUS not in TL.clean_transactions(spark, workdir).columns
    bad = IL.visible_table(spark, TL.transactions_config(workdir, str(f)), "bad", BAD_TRANSACTIONS).collect()
    rows = {json.loads(b.raw_row)["txn_id"]: json.loads(b.raw_row) for b in bad}
    assert rows["S2"]["null"] == ["more", "and, more"] and "null" not in rows["S3"] and rows["S3"]["channel"] is None


# --- S14: waiting for a file --------------------------------------------------------------

def test_wait_takes_a_late_file(spark, workdir):
    landing = os.path.join(workdir, "landing")
    cfg = TL.transactions_config(os.path.join(workdir, "t"), landing)

    def arrive():
        time.sleep(4)
        with open(os.path.join(workdir, "f.part"), "w") as f:
            f.write(HEADER + "W1,1,2026-01-01T10:00:00Z,10,NPR,pos\n")
        os.rename(os.path.join(workdir, "f.part"), os.path.join(landing, "f.csv"))

    late = threading.Thread(target=arrive)
    late.start()
    assert file_load.wait_for_files(spark, cfg, landing, os.path.join(workdir, "ck"), timeout=90, poke=1) == 1
    late.join()
    assert [r.txn_id for r in TL.clean_transactions(spark, cfg.root).collect()] == ["W1"]


def test_wait_without_a_file_times_out(spark, workdir):
    landing = os.path.join(workdir, "landing")
    cfg = TL.transactions_config(os.path.join(workdir, "t"), landing)
    began = time.monotonic()
    with pytest.raises(TimeoutError, match="no file in"):
        file_load.wait_for_files(spark, cfg, landing, os.path.join(workdir, "ck"), timeout=3, poke=1)
    assert 3 <= time.monotonic() - began < 60 and not spark.streams.active


# --- I8: dedupe in streaming state -----------------------------------------------------------

def test_dedupe_restarts_and_drops_late_rows(spark, workdir):
    from pyspark.sql import types as T

    from ledgerflow.streaming import dedupe

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("ts", T.TimestampType())])
    landing, out, ck = (os.path.join(workdir, d) for d in ("in", "out", "ck"))
    os.makedirs(landing)
    days = [["a,1", "b,2", "a,2", "c,"], ["b,3", "d,4", "e,9"], ["d,9", "f,3", "g,8", "e,10"]]
    for i, rows in enumerate(days):  # delay 3 days: f comes too late on the third call, d and e are repeated
        with open(os.path.join(landing, f"{i}.csv"), "w") as f:
            f.write("id,ts\n" + "".join(r.split(",")[0] + (f",2026-01-{int(r.split(',')[1]):02d}T00:00:00Z" if r.split(",")[1] else ",") + "\n" for r in rows))
        dedupe.run_available(spark, landing, schema, "id", "ts", out, ck, "3 days")
    dedupe.run_available(spark, landing, schema, "id", "ts", out, ck, "3 days")
    ids = sorted(r.id for r in dedupe.read_out(spark, out).collect())
    assert ids[:2] == ["a", "b"] and "f" not in ids and "c" not in ids and "g" in ids and ids.count("e") == 1
    assert any("rocksdb" in d.lower() or f.endswith((".zip", ".changelog")) for d, _, fs in os.walk(os.path.join(ck, "state")) for f in fs)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


# --- M2 W1: bucketed tables -------------------------------------------------------------------

def test_bucketed_side_has_no_exchange(spark, workdir):
    rows = spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    runs.write_bucketed(rows, "lf_bucketed", os.path.join(workdir, "b"), "k", 4)
    new = spark.range(390, 420).select(F.col("id").alias("k"), F.lit(99).cast("long").alias("v"))
    keep = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    try:
        for k, v in keep.items():
            spark.conf.set(k, v)
        merged = runs.upsert_bucketed(spark, "lf_bucketed", new, "k")
        plan = plan_text(merged, "simple")
        join = plan[plan.index("SortMergeJoin") :].splitlines()
        scan = next(i for i, line in enumerate(join) if "lf_bucketed" in line)
        assert not any("Exchange" in line for line in join[:scan])  # only the increment, printed after, is exchanged
        assert "Bucketed: true" in join[scan]
        newest = plan_text(runs.newest_in_bucketed(spark, "lf_bucketed", "k", ["v"]), "simple")
        assert "Exchange" not in newest and "Window" in newest
        got = {r.k: r.v for r in merged.collect()}
    finally:
        for k in keep:
            spark.conf.unset(k)
    assert len(got) == 420 and got[395] == got[419] == 99 and got[389] == 389 % 7
    assert len([f for f in os.listdir(os.path.join(workdir, "b")) if f.endswith(".parquet")]) == 4
    spark.sql("DROP TABLE lf_bucketed")


# --- X1: variants; S8 S10: defaults -------------------------------------------------------------

def test_variant_fields(spark):
    docs = ['{"a": {"z": 1.0, "b" : [1, {"c":null}]}, "n": null, "s": "x y", "d": 12.50, "t": true}', '{"a": ', "", None, "[1,2]", '{"a.b": 3}']
    v = X.variant("doc")
    df = spark.createDataFrame([(d,) for d in docs], "doc string").select(
        X.variant_text(v, "$.a").alias("a"), X.variant_text(v, "$.n").alias("n"), X.variant_text(v, "$.s").alias("s"),
        X.variant_value(v, "$.d", "decimal(6,2)").alias("d"), X.variant_value(v, "$.s", "int").alias("bad"), X.variant_text(v, "$[1]").alias("item"),
        X.variant_text(v, "$.t").alias("t"), X.variant_text(v, "$['a.b']").alias("dotted"),
    )
    rows = df.collect()
    assert rows[0].a == '{"b":[1,{"c":null}],"z":1}' and rows[0].n is None and rows[0].s == "x y" and rows[0].t == "true"
    assert float(rows[0].d) == 12.5 and rows[0].bad is None
    assert all(x is None for r in rows[1:4] for x in r) and rows[4].item == "2" and rows[5].dotted == "3"


def test_catalog_defaults(spark, workdir):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("c", T.StringType()), T.StructField("at", T.TimestampType())])
    spark.sql("DROP TABLE IF EXISTS lf_defaults")
    tables.create_with_defaults(spark, "lf_defaults", schema, {"c": "'NPR'", "at": "current_timestamp()"}, os.path.join(workdir, "d"))
    tables.insert_by_name(spark.createDataFrame([(1,)], "k int"), "lf_defaults")
    tables.insert_by_name(spark.createDataFrame([(None, 2)], "c string, k int"), "lf_defaults")
    rows = {r.k: r for r in spark.table("lf_defaults").collect()}
    assert rows[1].c == "NPR" and rows[2].c is None and rows[1].at is not None and rows[2].at is not None
    spark.sql("DROP TABLE lf_defaults")
