"""Registered queries of the load toolkit: totals by deltas, many files, two writers,
stateful dedupe, bucketed tables, ragged rows, sketches, variants, defaults.

Part of the registry of :mod:`ledgerflow.plans.keys`, which imports this module.
"""

from __future__ import annotations

import dataclasses
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions import scalars as X
from ledgerflow.operators import relational as R
from ledgerflow.plans import keys as K
from ledgerflow.plans.keys import FEED_COLUMNS, ORACLE_SQL, REDELIVERED_TYPE, register

# --- Q1-Q5 P9 A5: totals and sketches run by run -------------------------------------

# Fixed value: the third feed delivers all events from this time on again.
THIRD_FROM = "2024-01-20 00:00:00"
_THIRD = f"(SELECT * REPLACE (value + 2.0 AS value) FROM events WHERE ts >= TIMESTAMP '{THIRD_FROM}')"
_KEYS_OF_RUNS_SQL = (
    "WITH "
    + ",".join([K._checked_sql(), K._checked_sql(K._AGAIN, "again"), K._checked_sql(_THIRD, "third")])
    + """,
k AS (SELECT 1 AS run, t_id FROM checked WHERE error IS NULL
      UNION ALL SELECT 2, t_id FROM again WHERE error IS NULL
      UNION ALL SELECT 3, t_id FROM third WHERE error IS NULL),
totals AS (
  SELECT r.run, (SELECT COUNT(DISTINCT t_id) FROM k WHERE k.run <= r.run) AS total FROM (SELECT unnest([1, 2, 3]) AS run) r)
"""
)


def _three_loads(spark: SparkSession, sf_dir: str, **options):
    """Three overlapping feeds: all events, one type again, the last days again (with other values)."""
    from ledgerflow.jobs.incremental_load import run_load
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "three_loads")
    events = K._t(spark, sf_dir, "events")
    feeds = [
        events,
        events.where(F.col("event_type") == REDELIVERED_TYPE).withColumn("value", F.col("value") + F.lit(1.0)),
        events.where(F.col("ts") >= F.lit(THIRD_FROM).cast("timestamp_ntz")).withColumn("value", F.col("value") + F.lit(2.0)),
    ]
    cfg = dataclasses.replace(K._events_load_config(work, ""), lookback_hours=K.LONG_LOOKBACK_HOURS, **options)
    for i, feed in enumerate(feeds):
        text = feed.select(*[F.col(c).cast("string").alias(c) for c in FEED_COLUMNS])
        text.write.option("header", True).option("escape", '"').csv(f"{work}/feed-{i}")
        cfg = dataclasses.replace(cfg, source_path=f"{work}/feed-{i}")
        run_load(spark, cfg)
    return cfg


@register(
    "load_dq_delta",
    _KEYS_OF_RUNS_SQL
    + """
SELECT CAST(run AS BIGINT) AS run_id, CAST(run AS BIGINT) AS visible_runs, total AS clean_rows, total AS clean_keys,
       CAST(0 AS BIGINT) AS clean_non_positive, 'Total rows: ' || total || ', Distinct txn_id: ' || total AS details
FROM totals
""",
)
def load_dq_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of the clean table kept by deltas over three overlapping loads, and the check made of them."""
    from ledgerflow.jobs.incremental_load import read_ledger, visible_table
    from ledgerflow.operators import ledger as L
    from ledgerflow.operators.quality import DQ_NO_DUPLICATES
    from ledgerflow.schemas import DQ_RESULTS

    cfg = _three_loads(spark, sf_dir)
    runs = L.current_runs(read_ledger(spark, cfg)).select("run_id", "visible_runs", "clean_rows", "clean_keys", "clean_non_positive")
    checks = visible_table(spark, cfg, "dq", T.StructType([f for f in DQ_RESULTS.fields if f.name != "run_id"]))
    return runs.join(checks.where(F.col("check_name") == DQ_NO_DUPLICATES).select("run_id", "details"), "run_id")


@register(
    "distinct_by_run",
    _KEYS_OF_RUNS_SQL + "SELECT CAST(3 AS BIGINT) AS runs, total AS clean_keys, TRUE AS within_bound FROM totals WHERE run = 3",
)
def distinct_by_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: distinct keys of three runs from their stored sketches, within 5 % (three standard errors) of the exact count."""
    from ledgerflow.jobs.incremental_load import distinct_keys, read_ledger
    from ledgerflow.operators import ledger as L

    cfg = _three_loads(spark, sf_dir, sketch=True)
    exact = L.covering_totals(read_ledger(spark, cfg), 4).keys
    found = distinct_keys(spark, cfg)
    near = F.abs(F.col("estimate") - F.lit(exact)) <= F.lit(0.05 * exact)
    return found.select("runs", F.lit(exact).cast("bigint").alias("clean_keys"), near.alias("within_bound"))


# --- S1 S14: many small files ---------------------------------------------------------

# Fixed value: files of each of the two column orders.
FILES_PER_HEADER = 100


@register("many_files_load", K._CHECKED_EVENTS_SQL + K._VALID_EVENTS_SELECT)
def many_files_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A landing of 200 files with two column orders; the headers are found by one job."""
    from ledgerflow.jobs.incremental_load import read_clean, run_load
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "many_files")
    feed = K.events_feed(spark, sf_dir)
    half = F.pmod(F.xxhash64("event_id"), F.lit(2))
    for i, columns in enumerate((FEED_COLUMNS, FEED_COLUMNS[::-1])):
        part = feed.where(half == i).select(*columns).repartition(FILES_PER_HEADER)
        part.write.mode("append").option("header", True).option("escape", '"').csv(f"{work}/landing")
    cfg = K._events_load_config(work, f"{work}/landing")
    run_load(spark, cfg)
    return K._as_double(read_clean(spark, cfg), "value").select(*FEED_COLUMNS)


# --- M5 S11: two loads at once -------------------------------------------------------

@register(
    "two_writers",
    K._CHECKED_EVENTS_SQL + f"SELECT v.*, CAST(2 AS BIGINT) AS runs FROM ({K._VALID_EVENTS_SELECT}) v",
)
def two_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of overlapping feeds started together get an id each, and no row is lost."""
    from ledgerflow.jobs.incremental_load import read_clean, read_ledger, run_load
    from ledgerflow.operators import ledger as L
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "two_writers")
    feed = K.events_feed(spark, sf_dir)
    third = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for i in range(2):  # a third of the rows is in both feeds
        feed.where((third == 2) | (third == i)).write.option("header", True).option("escape", '"').csv(f"{work}/feed-{i}")
    cfgs = [K._events_load_config(work, f"{work}/feed-{i}") for i in range(2)]
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda c: run_load(spark, c, use_cutoff=False), cfgs))
    runs = L.successful_run_ids(read_ledger(spark, cfgs[0])).count()
    clean = K._as_double(read_clean(spark, cfgs[0]), "value")
    return clean.select(*FEED_COLUMNS, F.lit(runs).cast("bigint").alias("runs"))


# --- I8: dedupe in streaming state ------------------------------------------------------

# Event times of the three landings, and the first days delivered once more, too late.
LANDINGS = [("2024-01-01", "2024-01-12"), ("2024-01-10", "2024-01-22"), ("2024-01-20", "2025-01-01")]
LATE_UNTIL = "2024-01-03"
DEDUPE_DELAY = "3 days"


@register("stream_dedupe", "SELECT event_id, ts, user_id, event_type, value FROM events WHERE ts IS NOT NULL")
def stream_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I8: three overlapping landings, the query restarted from its checkpoint for each; every key comes out once."""
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming import dedupe

    work = scratch_path(spark, "stream_dedupe")
    events = K._t(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    for i, (start, end) in enumerate(LANDINGS):
        wanted = (F.col("ts") >= F.lit(start).cast("timestamp")) & (F.col("ts") < F.lit(end).cast("timestamp"))
        if i == len(LANDINGS) - 1:
            wanted |= F.col("ts") < F.lit(LATE_UNTIL).cast("timestamp")
        rows = events.where(wanted).withColumn("ts", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        rows.write.mode("append").option("header", True).option("escape", '"').csv(f"{work}/landing")
        dedupe.run_available(spark, f"{work}/landing", events.schema, "event_id", "ts", f"{work}/out", f"{work}/checkpoint", DEDUPE_DELAY)
    return dedupe.read_out(spark, f"{work}/out").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


# --- M2 W1: bucketed tables -------------------------------------------------------------

# Fixed value: buckets of the table (on a cluster: its size over some 256 MB).
ORDER_BUCKETS = 16


def bucketed_orders(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """The existing orders as a bucketed catalog table, and the increment."""
    from ledgerflow.session import scratch_path
    from ledgerflow.sources.runs import write_bucketed

    target, source = K._order_versions(spark, sf_dir)
    table = f"orders_bucketed_{uuid.uuid4().hex[:8]}"
    write_bucketed(target, table, scratch_path(spark, table), "o_orderkey", ORDER_BUCKETS)
    return table, source


@register("bucketed_upsert", ORACLE_SQL["upsert_orders"])
def bucketed_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2: the increment meets a table bucketed by key; only the increment is exchanged."""
    from ledgerflow.sources.runs import upsert_bucketed

    table, source = bucketed_orders(spark, sf_dir)
    return upsert_bucketed(spark, table, source, "o_orderkey")


# --- S1 V3 X2: short and long rows --------------------------------------------------------

_RAGGED_SQL = "(SELECT * REPLACE (CASE WHEN user_id % 3 = 1 THEN NULL ELSE props END AS props) FROM events)"


@register(
    "ragged_feed",
    "WITH "
    + K._checked_sql(_RAGGED_SQL)
    + """
SELECT event_id,
       CASE WHEN CAST(user_id AS BIGINT) % 3 = 0
         THEN json_object('event_id', event_id, 'ts', ts, 'user_id', user_id, 'event_type', event_type, 'value', value,
                          'props', props, 'null', ['x', 'a "b", c', ''])::VARCHAR
         ELSE json_object('event_id', event_id, 'ts', ts, 'user_id', user_id, 'event_type', event_type, 'value', value,
                          'props', props)::VARCHAR END AS raw_row,
       error
FROM checked WHERE error IS NOT NULL
""",
)
def ragged_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with three fields too many or one too few; the quarantined JSON holds the surplus."""
    from ledgerflow.operators.quality import SURPLUS, bad_rows, validate
    from ledgerflow.session import scratch_path
    from ledgerflow.sources.files import read_csv_strings

    work = scratch_path(spark, "ragged_feed")
    events = K.events_feed(spark, sf_dir)
    props = F.concat(F.lit('"'), F.replace(F.col("props"), F.lit('"'), F.lit('""')), F.lit('"'))
    user = F.col("user_id").cast("bigint") % 3
    tail = F.when(user == 1, F.lit("")).when(user == 0, F.concat(F.lit(","), props, F.lit(',x,"a ""b"", c",'))).otherwise(F.concat(F.lit(","), props))
    line = F.concat(F.concat_ws(",", *FEED_COLUMNS[:-1]), tail)
    # one column named as the whole header, written without quoting: lines as a careless producer writes them
    events.select(line.alias(",".join(FEED_COLUMNS))).write.option("header", True).option("sep", "\x01").option("quote", "\x00").csv(work)
    feed = read_csv_strings(spark, work, FEED_COLUMNS, surplus=SURPLUS).withColumn("_raw_id", F.col("event_id"))
    spec = K.events_spec()
    spec.extra_columns, spec.surplus_col = ("_raw_id",), SURPLUS
    return bad_rows(validate(feed, spec), "_raw_id").withColumnRenamed("_raw_id", "event_id")


# --- X1: nested JSON --------------------------------------------------------------------

_NESTED_SQL = """
WITH j AS (
  SELECT event_id, CASE WHEN event_type = 'error' THEN props[:5] ELSE
    '{"z": ' || props || ',  "n": {"type":"' || event_type || '" , "tags": ["' || event_type || '",null], "user": ' || user_id || '}, "none": null}' END AS doc
  FROM events)
"""


@register(
    "event_variant_fields",
    _NESTED_SQL
    + """,
p AS (SELECT event_id, TRY_CAST(doc AS JSON) AS v FROM j)
SELECT event_id, v IS NOT NULL AS is_json, v->>'$.n.type' AS type, CAST(v->>'$.n.user' AS BIGINT) AS user_id,
       CAST(v->>'$.z.k' AS INTEGER) AS k, v->>'$.n.tags[0]' AS first_tag, TRY_CAST(v->>'$.n.type' AS INTEGER) AS no_number,
       CASE WHEN v IS NOT NULL THEN '{"tags":["' || (v->>'$.n.type') || '",null],"type":"' || (v->>'$.n.type') || '","user":' || (v->>'$.n.user') || '}' END AS nested,
       v->>'$.none' AS none, v->>'$.absent' AS absent
FROM p
""",
)
def event_variant_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of nested documents as text and as typed values, JSON null, absent members, broken JSON."""
    t, u = F.col("event_type"), F.col("user_id").cast("string")
    doc = F.concat(
        F.lit('{"z": '), "props", F.lit(',  "n": {"type":"'), t, F.lit('" , "tags": ["'), t, F.lit('",null], "user": '), u, F.lit('}, "none": null}')
    )
    events = K._t(spark, sf_dir, "events")
    docs = events.select("event_id", X.variant(F.when(t == "error", F.substring("props", 1, 5)).otherwise(doc)).alias("v"))
    v = F.col("v")
    return docs.select(
        "event_id", v.isNotNull().alias("is_json"), X.variant_text(v, "$.n.type").alias("type"), X.variant_value(v, "$.n.user", "bigint").alias("user_id"),
        X.variant_value(v, "$.z.k", "int").alias("k"), X.variant_text(v, "$.n.tags[0]").alias("first_tag"), X.variant_value(v, "$.n.type", "int").alias("no_number"),
        X.variant_text(v, "$.n").alias("nested"), X.variant_text(v, "$.none").alias("none"), X.variant_text(v, "$.absent").alias("absent"),
    )


# --- S8 S10: defaults of the catalog ------------------------------------------------------

# Defaults of the accounts table, as the banking schema declares them.
ACCOUNT_DEFAULTS = {"currency": "'NPR'", "status": "'running'", "rows": "0", "tags": "array()"}


@register(
    "inserted_defaults",
    """
SELECT c_custkey AS customer_id, 'NPR' AS currency, 'running' AS status, 0 AS rows, 0 AS n_tags FROM customer
UNION ALL
SELECT c_custkey, NULL, c_mktsegment, 7, 0 FROM customer WHERE c_mktsegment = 'BUILDING'
""",
)
def inserted_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows inserted without some columns take the catalog's defaults; an explicit NULL stays."""
    from ledgerflow.session import scratch_path
    from ledgerflow.sources.tables import create_with_defaults, insert_by_name

    name = f"accounts_{uuid.uuid4().hex[:8]}"
    schema = T.StructType([
        T.StructField("customer_id", T.LongType()), T.StructField("currency", T.StringType()), T.StructField("status", T.StringType()),
        T.StructField("rows", T.IntegerType()), T.StructField("tags", T.ArrayType(T.StringType())),
    ])
    create_with_defaults(spark, name, schema, ACCOUNT_DEFAULTS, scratch_path(spark, name))
    customer = K._t(spark, sf_dir, "customer")
    insert_by_name(customer.select(F.col("c_custkey").alias("customer_id")), name)
    named = customer.where(F.col("c_mktsegment") == K.SEGMENT)
    insert_by_name(
        named.select(F.col("c_custkey").alias("customer_id"), F.lit(None).cast("string").alias("currency"), F.col("c_mktsegment").alias("status"), F.lit(7).alias("rows")),
        name,
    )
    return spark.table(name).select("customer_id", "currency", "status", "rows", F.size("tags").alias("n_tags"))


# --- T3: position in a total sort -------------------------------------------------------------

@register(
    "sorted_positions",
    """
SELECT o_orderkey, o_orderpriority, o_totalprice,
       row_number() OVER (ORDER BY o_orderpriority ASC NULLS LAST, o_totalprice DESC NULLS FIRST, o_orderkey ASC NULLS LAST) AS position
FROM orders
""",
)
def sorted_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with its position in a sort over three keys of mixed direction."""
    from ledgerflow.operators.keys import assign_surrogate_keys

    orders = K._t(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return assign_surrogate_keys(orders, [R.asc("o_orderpriority"), R.desc("o_totalprice"), R.asc("o_orderkey")], "position")


# --- S6 I5 I6: a load that fails on repeated keys ------------------------------------------------

@register(
    "failed_reload",
    K._CHECKED_EVENTS_SQL
    + f""",
valid AS ({K._VALID_EVENTS_SELECT})
SELECT CAST(1 AS BIGINT) AS run_id, 'success' AS status, 'OK' AS message, (SELECT COUNT(*) FROM valid) AS visible_rows,
       (SELECT max(ts) FROM valid) AS watermark, (SELECT max(ts) FROM valid) AS kept_watermark
UNION ALL
SELECT 2, 'failed', 'duplicate key value violates unique constraint (event_id): ' || (SELECT COUNT(*) FROM valid WHERE event_type = '{REDELIVERED_TYPE}') || ' keys',
       0, NULL, (SELECT max(ts) FROM valid)
""",
)
def failed_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with repeated keys fails in the strict mode, shows nothing and leaves the watermark where it was."""
    from ledgerflow.jobs.incremental_load import read_ledger, run_load, visible_table
    from ledgerflow.operators import ledger as L
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "failed_reload")
    K._write_feed_csv(spark, sf_dir, f"{work}/first")
    twice = K.events_feed(spark, sf_dir).where(F.col("event_type") == REDELIVERED_TYPE)
    twice.unionByName(twice).write.option("header", True).option("escape", '"').csv(f"{work}/second")
    cfg = dataclasses.replace(K._events_load_config(work, f"{work}/first"), lookback_hours=K.LONG_LOOKBACK_HOURS, on_duplicate="error")
    run_load(spark, cfg)
    try:
        run_load(spark, dataclasses.replace(cfg, source_path=f"{work}/second"))
    except RuntimeError as exc:
        if "duplicate key" not in str(exc):
            raise
    ledger = read_ledger(spark, cfg)
    raw = visible_table(spark, cfg, "raw", T.StructType([T.StructField("event_id", T.StringType())]))
    rows = raw.groupBy("run_id").agg(F.count(F.lit(1)).alias("visible_rows"))
    kept = L.ledger_state(ledger)[1]
    out = L.current_runs(ledger).select("run_id", "status", "message", F.col("watermark").cast("timestamp_ntz").alias("watermark"))
    out = out.join(rows, "run_id", "left").withColumn("visible_rows", F.coalesce("visible_rows", F.lit(0).cast("bigint")))
    return out.withColumn("kept_watermark", F.lit(kept).cast("timestamp_ntz"))


# --- S12: counts after a load --------------------------------------------------------------------

@register(
    "dimension_counts",
    f"""
SELECT 'staging_customers' AS table_name,
       COUNT(*) + COUNT(*) FILTER (p_size <= {K.AGAIN_UP_TO_SIZE}) AS rows FROM part WHERE p_size < {K.BAD_ID_FROM_SIZE}
UNION ALL
SELECT 'dim_customer', COUNT(*) FROM part WHERE p_size < {K.BAD_ID_FROM_SIZE}
""",
)
def dimension_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the staging table and of the dimension after the load."""
    from ledgerflow.jobs import customer_dim as job
    from ledgerflow.sources.tables import count_tables

    root = K._dimension_load(spark, sf_dir)
    return count_tables({"staging_customers": spark.read.parquet(f"{root}/staging_customers"), "dim_customer": job.current_dimension(spark, root)})


# --- X13: minus hours -------------------------------------------------------------------------

@register("lookback_times", f"SELECT event_id, ts - INTERVAL {K.LOOKBACK_HOURS} HOUR AS cutoff FROM events")
def lookback_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cutoff that each event's time would give as a watermark."""
    return K._t(spark, sf_dir, "events").select("event_id", X.minus_hours("ts", K.LOOKBACK_HOURS).alias("cutoff"))
