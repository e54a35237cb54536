"""Namespaces, defaults, watermark state, ledger visibility, constraint reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import incremental as I
from ledgerflow.operators import ledger as L
from ledgerflow.operators import quality as Q
from ledgerflow.schemas import ETL_RUNS
from ledgerflow.sources import tables as TB


def test_namespace_and_create_if_absent(spark):
    TB.use_namespace(spark, "lf_test_ns", reset=True)
    TB.ensure_table(spark, "etl_state", I.STATE_SCHEMA)
    TB.ensure_table(spark, "etl_state", I.STATE_SCHEMA)  # idempotent
    assert spark.catalog.currentDatabase() == "lf_test_ns"
    assert spark.table("etl_state").count() == 0
    spark.catalog.setCurrentDatabase("default")
    spark.sql("DROP DATABASE lf_test_ns CASCADE")


def test_read_or_empty(spark, workdir):
    df = TB.read_or_empty(spark, workdir + "/missing", ETL_RUNS)
    assert df.count() == 0 and df.schema == ETL_RUNS


def test_with_defaults(spark):
    df = spark.createDataFrame([("a", None)], "k string, currency string")
    out = TB.with_defaults(df, {"currency": F.lit("NPR"), "tags": F.array().cast("array<string>")})
    r = out.first()
    assert r.currency is None and r.tags == []  # an explicit NULL stays


def test_watermark_state(spark):
    state = I.state_frame(spark, "job", None)
    assert I.get_watermark(state, "job") is None
    assert I.compute_cutoff(None, 24) is None
    state = I.set_watermark(state, "job", dt.datetime(2026, 1, 5, 4, 20))
    assert I.get_watermark(state, "job") == dt.datetime(2026, 1, 5, 4, 20)
    back = I.set_watermark(state, "job", dt.datetime(2026, 1, 1))
    assert I.get_watermark(back, "job") == dt.datetime(2026, 1, 1)  # may move backwards
    mono = I.set_watermark(state, "job", dt.datetime(2026, 1, 1), monotonic=True)
    assert I.get_watermark(mono, "job") == dt.datetime(2026, 1, 5, 4, 20)
    assert I.compute_cutoff(dt.datetime(2026, 1, 5, 4, 20), 24) == dt.datetime(2026, 1, 4, 4, 20)


def test_late_filter_passes_unparseable(spark):
    df = spark.createDataFrame(
        [("2026-01-04T04:20:00+00:00",), ("2026-01-04T04:19:59+00:00",), ("",), ("junk",), (None,)], "ts string"
    )
    kept = [r.ts for r in I.late_data_filter(df, "ts", dt.datetime(2026, 1, 4, 4, 20)).collect()]
    assert kept == ["2026-01-04T04:20:00+00:00", "", "junk", None]


def test_ledger_visibility(spark):
    events = [
        L.run_event(spark, 1, 1, L.RUNNING, "f"), L.run_event(spark, 1, 2, L.SUCCESS, "f"),
        L.run_event(spark, 2, 1, L.RUNNING, "f"), L.run_event(spark, 2, 2, L.FAILED, "f"),
        L.run_event(spark, 3, 1, L.RUNNING, "f"),
    ]
    ledger = events[0]
    for e in events[1:]:
        ledger = ledger.unionByName(e)
    assert sorted((r.run_id, r.status) for r in L.current_runs(ledger).collect()) == [
        (1, "success"), (2, "failed"), (3, "running")
    ]
    data = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "run_id bigint, v string")
    assert [r.v for r in L.visible(data, ledger).collect()] == ["a"]
    assert L.next_run_id(ledger) == 4


def test_constraint_reports(spark):
    parent = spark.createDataFrame([(1,), (2,)], "id int")
    child = spark.createDataFrame(
        [(1, 1, "active", 1.0), (2, 3, "frozen", 2.0), (2, None, "weird", 99999999999.0), (None, 2, None, None)],
        "id int, fk int, status string, amount double",
    )
    rep = Q.violations_report(
        Q.not_null_report(child, "c", ["id", "fk"]),
        Q.unique_report(child, "c", ["id"]),
        Q.foreign_key_report(child, "c", "fk", parent, "id"),
        Q.domain_report(child, "c", "status", ["active", "frozen", "closed"]),
        Q.precision_report(child, "c", "amount"),
    )
    got = {(r.rule, r.column_name): r.violations for r in rep.collect()}
    assert got == {
        ("not_null", "id"): 1, ("not_null", "fk"): 1, ("unique", "id"): 1,
        ("foreign_key", "fk"): 1, ("domain", "status"): 1, ("precision", "amount"): 1,
    }


def test_keys_report_equals_the_single_reports(spark):
    parent = spark.createDataFrame([(1,), (2,), (2,), (None,), (None,), (7,)], "id int")
    child = spark.createDataFrame(
        [(1, 1), (1, 1), (2, 1), (2, 2), (3, 1), (3, 1), (3, 2), (None, 1), (None, 1), (4, None)], "fk int, line int"
    )
    got = Q.keys_report(child, "c", ["fk", "line"], "fk", parent, "p", "id").collect()
    single = Q.violations_report(
        Q.unique_report(parent, "p", ["id"]), Q.unique_report(child, "c", ["fk", "line"]),
        Q.foreign_key_report(child, "c", "fk", parent, "id"),
    )
    assert sorted(map(tuple, got)) == sorted(map(tuple, single.collect()))
    empty = Q.keys_report(child.limit(0), "c", ["fk", "line"], "fk", parent.limit(0), "p", "id")
    assert [r.violations for r in empty.collect()] == [0, 0, 0]


def test_stream_dedupe_within_watermark(spark, workdir):
    """The append-only alternative: repeated ids inside the watermark are dropped."""
    import os

    from ledgerflow.streaming.file_load import dedupe_within_watermark

    landing = os.path.join(workdir, "in")
    os.makedirs(landing)
    with open(os.path.join(landing, "a.csv"), "w") as f:
        f.write("id,ts\n1,2026-01-01 10:00:00\n2,2026-01-01 10:01:00\n1,2026-01-01 10:02:00\n")
    stream = spark.readStream.schema("id string, ts string").option("header", True).csv(landing)
    stream = stream.select("id", F.col("ts").cast("timestamp").alias("ts"))
    q = (dedupe_within_watermark(stream, "id", "ts", "1 hour").writeStream.format("memory")
         .queryName("dedupe_wm").trigger(availableNow=True).option("checkpointLocation", os.path.join(workdir, "ck")).start())
    q.awaitTermination()
    assert sorted(r.id for r in spark.table("dedupe_wm").collect()) == ["1", "2"]


def test_read_csv_typed_and_strings(spark, tmp_path):
    from pyspark.sql import types as T

    from ledgerflow.sources.files import read_csv_strings, read_csv_typed, require_columns

    p = tmp_path / "c.csv"
    p.write_text('customer_id,full_name,email\n101,"Rai, Nisha",n@x\n\n102,Sarita Karki\n')
    schema = T.StructType([T.StructField("customer_id", T.IntegerType()), T.StructField("full_name", T.StringType()),
                           T.StructField("email", T.StringType())])
    typed = read_csv_typed(spark, str(p), schema).collect()
    assert [(r.customer_id, r.full_name, r.email) for r in typed] == [(101, "Rai, Nisha", "n@x"), (102, "Sarita Karki", None)]
    inferred = read_csv_typed(spark, str(p))
    assert dict(inferred.dtypes)["customer_id"] == "int"
    text = read_csv_strings(spark, str(p), ["customer_id", "email", "missing"])
    assert text.dtypes == [("customer_id", "string"), ("email", "string"), ("missing", "string")]
    require_columns(text, ["customer_id"])


def test_dq_checks_exact_and_approximate(spark):
    from pyspark.sql import functions as F

    clean = spark.range(0, 5000).select(
        (F.col("id") % 4000).alias("k"), F.lit(1).alias("part"), F.lit(5.0).alias("amount"),
        F.when(F.col("id") < 10, F.lit(7)).otherwise(F.lit(3)).alias("last_run_id"),
    )
    exact = {r.check_name: r for r in Q.dq_checks(clean, ["k", "part"], "amount", "last_run_id", 7, 5000).collect()}
    assert exact["no_duplicates_in_clean_transactions"].metric == 1000.0
    assert not exact["no_duplicates_in_clean_transactions"].passed
    assert exact["recent_run_influenced_clean"].metric == 10.0 and exact["recent_run_influenced_clean"].passed
    assert exact["no_non_positive_amounts_in_clean"].passed and exact["min_rows_loaded_nonzero"].passed
    approx = {r.check_name: r for r in Q.dq_checks(clean, ["k", "part"], "amount", "last_run_id", 7, 5000,
                                                    approximate=True).collect()}
    assert abs(approx["no_duplicates_in_clean_transactions"].metric - 1000.0) < 300


def test_ledger_retry_supersedes_failed_attempt(spark):
    t0 = dt.datetime(2026, 1, 1, 10, 0, tzinfo=dt.timezone.utc)
    ev = [
        L.run_event(spark, 1, 1, L.RUNNING, "b", at=t0),
        L.run_event(spark, 1, 2, L.FAILED, "b", at=t0 + dt.timedelta(minutes=1)),
        L.run_event(spark, 1, 1, L.RUNNING, "b", at=t0 + dt.timedelta(minutes=2)),
    ]
    ledger = ev[0].unionByName(ev[1]).unionByName(ev[2])
    assert L.current_runs(ledger).first().status == "running"
    ledger = ledger.unionByName(L.run_event(spark, 1, 2, L.SUCCESS, "b", at=t0 + dt.timedelta(minutes=3)))
    assert L.current_runs(ledger).first().status == "success"


def test_read_or_empty_hides_no_other_error(spark, workdir):
    import os

    from pyspark.errors import AnalysisException

    with open(os.path.join(workdir, "table"), "w") as f:
        f.write("x")
    for bad in ("nosuchfs://x/y",):
        with pytest.raises(Exception) as e:
            TB.read_or_empty(spark, bad, ETL_RUNS).count()
        assert not isinstance(e.value, AnalysisException) or e.value.getCondition() != "PATH_NOT_FOUND"


def test_sort_total_gives_the_order(spark):
    from ledgerflow.operators import relational as R

    rows = [(2, "b", 1.0), (1, None, 2.0), (1, "a", None), (None, "z", 0.0), (1, "a", 3.0)]
    df = spark.createDataFrame(rows, "k int, name string, v double").repartition(4)
    got = [tuple(r) for r in R.sort_total(df, [R.asc("k"), R.asc("name"), R.desc("v")]).collect()]
    assert got == [(1, "a", None), (1, "a", 3.0), (1, None, 2.0), (2, "b", 1.0), (None, "z", 0.0)]
