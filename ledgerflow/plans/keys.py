"""The query registry: every operator of SURVEY §2 applied to the driver's
tables, each with an independent DuckDB oracle (SURVEY §2.14).

Role mapping: customer -> customers, orders -> accounts (status, date),
lineitem -> transactions (amount), supplier -> merchants, events -> the CSV
feed and JSON metadata, part names -> tags and full names. Money is rounded
to ``DECIMAL(12,2)``, summed exactly (as whole cents here, as decimals in the
oracle) and returned as double, so sums do not depend on the order partial
aggregates meet.

Every query reads whole tables; no key subsets or row caps. ``LIMIT`` only
appears where it is the operator (top-k, first-k).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions import scalars as X
from ledgerflow.operators import relational as R
from ledgerflow.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql.strip()
        return fn

    return deco


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, sf_dir, name)


# Fixed values of the revenue queries (the P1/P2 role mapping).
SEGMENT = "BUILDING"
POSTED_STATUS = "F"
DATE_LO = "1996-01-01 00:00:00"
DATE_HI = "1997-01-01 00:00:00"


# --- P1 -------------------------------------------------------------------------

def _revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted revenue per customer, exact.

    The filtered orders meet their customers first; line items then join that
    selective side (a runtime bloom filter drops other orders' line items
    before their shuffle, where nothing is small enough to broadcast), and the
    total is one aggregate with a partial step. A hot order is split by the
    adaptive skew join.
    """
    customer = R.where_equals(_t(spark, sf_dir, "customer"), c_mktsegment=SEGMENT)
    orders = R.where_between(
        R.where_equals(_t(spark, sf_dir, "orders"), o_orderstatus=POSTED_STATUS),
        "o_orderdate",
        DATE_LO,
        DATE_HI,
    )
    wanted = R.join_chain(
        orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")),
        (customer.select("c_custkey", "c_name"), "c_custkey"),
    )
    lineitem = _t(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    joined = R.join_chain(wanted, (lineitem, "o_orderkey"))
    return R.grouped_totals(joined, ["c_custkey", "c_name"], "l_extendedprice")


def _as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Exact money as double, which both engines of the comparison have."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


_REVENUE_SQL = f"""
SELECT c.c_custkey, c.c_name,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS total_amount,
       COUNT(*) AS txn_count
FROM customer c
JOIN orders o ON o.o_custkey = c.c_custkey
JOIN lineitem l ON l.l_orderkey = o.o_orderkey
WHERE c.c_mktsegment = '{SEGMENT}' AND o.o_orderstatus = '{POSTED_STATUS}'
  AND o.o_orderdate >= TIMESTAMP '{DATE_LO}' AND o.o_orderdate < TIMESTAMP '{DATE_HI}'
GROUP BY c.c_custkey, c.c_name
"""


@register("revenue_per_customer", _REVENUE_SQL)
def revenue_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P1 J1 F4 F5 A1."""
    return _as_double(_revenue(spark, sf_dir), "total_amount")


# --- P2 -------------------------------------------------------------------------

@register(
    "top_customers",
    f"SELECT * FROM ({_REVENUE_SQL}) r ORDER BY total_amount DESC, c_custkey LIMIT 5",
)
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five customers with the largest posted revenue (ties by key)."""
    top = R.top_k(_revenue(spark, sf_dir), 5, [R.desc("total_amount"), R.asc("c_custkey")])
    return _as_double(top, "total_amount")


# --- P3 -------------------------------------------------------------------------

@register(
    "latest_order_per_customer",
    """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderstatus
FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                                   ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
      FROM orders) x
WHERE rn = 1
""",
)
def latest_order_per_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest order of every customer (date, then order key, descending)."""
    latest = R.latest_per_key(
        _t(spark, sf_dir, "orders"),
        ["o_custkey"],
        ["o_orderdate", "o_orderkey"],
        ["o_orderkey", "o_orderdate", "o_totalprice", "o_orderstatus"],
    )
    return R.sort_total(latest, [R.asc("o_custkey")])


# --- P4 -------------------------------------------------------------------------

@register(
    "supplier_spend_rank",
    f"""
SELECT c_custkey, c_name, s_name, CAST(money AS DOUBLE) AS total_spend,
       rank() OVER (PARTITION BY c_custkey ORDER BY money DESC) AS spend_rank
FROM (SELECT o_custkey AS c_custkey, l_suppkey AS s_suppkey,
             SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS money
      FROM lineitem, orders
      WHERE l_orderkey = o_orderkey AND o_orderstatus = '{POSTED_STATUS}'
      GROUP BY ALL)
     JOIN customer USING (c_custkey) JOIN supplier USING (s_suppkey)
""",
)
def supplier_spend_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posted spend per (customer, supplier), ranked per customer.

    Spend is first summed per (customer key, supplier key) right after the
    fact join, so the name lookups in customer and supplier join aggregated
    pairs instead of line items. Supplier names are distinct, so a pair of keys
    is a pair of names. Ranks compare exact money.
    """
    orders = R.where_equals(_t(spark, sf_dir, "orders"), o_orderstatus=POSTED_STATUS)
    lineitem = _t(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_suppkey").alias("s_suppkey"), "l_extendedprice"
    )
    facts = R.join_chain(lineitem, (orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), "o_orderkey"))
    pairs = R.grouped_totals(facts, ["c_custkey", "s_suppkey"], "l_extendedprice", "total_spend", None)
    named = R.join_chain(
        pairs,
        (_t(spark, sf_dir, "customer").select("c_custkey", "c_name"), "c_custkey"),
        (_t(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey"),
    )
    ranked = R.rank_within(named, ["c_custkey"], "total_spend", "spend_rank")
    ranked = _as_double(ranked.withColumn("spend_rank", F.col("spend_rank").cast("bigint")), "total_spend")
    ranked = ranked.select("c_custkey", "c_name", "s_name", "total_spend", "spend_rank")
    return R.sort_total(ranked, [R.asc("c_custkey"), R.asc("spend_rank"), R.desc("total_spend")])


# --- P5 -------------------------------------------------------------------------

@register(
    "event_json_fields",
    """
SELECT event_id, ts, value,
       json_extract_string(props, '$.k') AS k,
       json_extract_string(props, '$.ip') AS ip
FROM events ORDER BY ts, event_id LIMIT 12
""",
)
def event_json_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First 12 events by time with JSON fields (``ip`` is absent -> NULL)."""
    ev = _t(spark, sf_dir, "events").select("event_id", "ts", "value", "props")
    # Take the first rows, then parse: TakeOrderedAndProject evaluates the
    # JSON projection on the 12 winners only, not on every event.
    first = R.top_k(ev, 12, [R.asc("ts"), R.asc("event_id")])
    return first.select("event_id", "ts", "value", *X.json_fields("props", ["k", "ip"]))


# --- P6 / P7 --------------------------------------------------------------------

# Fixed value: the tag P6 looks for among the words of a part name.
WANTED_TAG = "red"


@register(
    "parts_with_tags",
    f"SELECT p_partkey, p_name FROM part WHERE list_has_all(string_split(p_name, ' '), ['{WANTED_TAG}'])",
)
def parts_with_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name words contain the tag (array containment)."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", F.split("p_name", " ").alias("tags"))
    return R.where_contains_all(part, "tags", [WANTED_TAG]).select("p_partkey", "p_name")


@register(
    "tag_counts",
    """
WITH words AS (SELECT unnest(string_split(p_name, ' ')) AS word FROM part)
SELECT word AS tag, COUNT(*) AS part_count FROM words GROUP BY word
""",
)
def tag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of parts per name word (unnest + count)."""
    part = _t(spark, sf_dir, "part").select(F.split("p_name", " ").alias("tags"))
    counts = R.explode_counts(part, "tags", "tag", "part_count")
    return R.sort_total(counts, [R.desc("part_count"), R.asc("tag")])


# Two words that some part names share.
MANY_TAGS = ["plate", "red"]


@register(
    "many_tags",
    "SELECT p_partkey, p_name FROM part WHERE "
    + " AND ".join(f"list_contains(string_split(p_name, ' '), '{t}')" for t in MANY_TAGS),
)
def many_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts whose name has every one of several words."""
    part = _t(spark, sf_dir, "part").select("p_partkey", "p_name", F.split("p_name", " ").alias("tags"))
    return R.where_contains_all(part, "tags", MANY_TAGS).select("p_partkey", "p_name")


# --- P8 -------------------------------------------------------------------------

_COUNTED = ["customer", "orders", "lineitem", "supplier", "part"]


@register(
    "table_row_counts",
    "\nUNION ALL\n".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}" for t in _COUNTED),
)
def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled row counts of five tables."""
    return R.labelled_counts({t: _t(spark, sf_dir, t) for t in _COUNTED}, "table_name", "row_count")


# --- V / A7: validation and quarantine of the events feed -------------------------

# Fixed values of the events feed rules (the transactions feed uses NPR and
# pos/web/mobile, see ledgerflow.jobs.transactions_load).
EVENT_TYPES = ["click", "view", "purchase"]
EVENT_MIN_VALUE = 1.0
FEED_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a text feed: every field a string, as a CSV scan yields."""
    ev = _t(spark, sf_dir, "events")
    return ev.select(*[F.col(c).cast("string").alias(c) for c in FEED_COLUMNS])


def events_spec():
    from ledgerflow.operators.quality import FeedSpec

    return FeedSpec(
        id_col="event_id",
        int_cols=["user_id"],
        number_col="value",
        ts_col="ts",
        domains=[("event_type", EVENT_TYPES, "lower")],
        min_exclusive=EVENT_MIN_VALUE,
        ts_type="timestamp_ntz",
        raw_columns=FEED_COLUMNS,
    )


def validated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ledgerflow.operators.quality import validate

    return validate(events_feed(spark, sf_dir), events_spec())


_WS = r"'^\s+|\s+$'"
_NUM = r"'^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$'"
def _checked_sql(relation: str = "events", name: str = "checked") -> str:
    """CTEs that validate a feed: every row of ``relation`` as text, typed, with its first error."""
    return f"""
{name}_feed AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(ts AS VARCHAR) AS ts,
         CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props
  FROM {relation}),
{name}_typed AS (
  SELECT *,
    regexp_replace(event_id, {_WS}, '', 'g') AS t_id,
    TRY_CAST(regexp_replace(user_id, {_WS}, '', 'g') AS INTEGER) AS t_user,
    TRY_CAST(regexp_replace(ts, {_WS}, '', 'g') AS TIMESTAMP) AS t_ts,
    CASE WHEN regexp_matches(regexp_replace(value, {_WS}, '', 'g'), {_NUM})
         THEN TRY_CAST(regexp_replace(value, {_WS}, '', 'g') AS DOUBLE) END AS t_value,
    lower(regexp_replace(event_type, {_WS}, '', 'g')) AS t_type
  FROM {name}_feed),
{name} AS (
  SELECT *,
    CASE
      WHEN t_id IS NULL OR t_id = '' THEN 'event_id is empty'
      WHEN t_user IS NULL THEN 'validation error: invalid user_id: ' || coalesce(user_id, 'null')
      WHEN t_value IS NULL THEN 'validation error: invalid value: ' || coalesce(value, 'null')
      WHEN t_value <= {EVENT_MIN_VALUE} THEN 'value must be > 1'
      WHEN t_type IS NULL OR t_type NOT IN ({", ".join(f"'{e}'" for e in EVENT_TYPES)})
        THEN 'unsupported event_type: ' || coalesce(t_type, 'null')
      WHEN t_ts IS NULL THEN 'validation error: invalid ts: ' || coalesce(ts, 'null')
      WHEN isnan(t_value) OR isinf(t_value) OR TRY_CAST(t_value AS DECIMAL(12,2)) IS NULL
        THEN 'validation error: value out of range: ' || value
    END AS error
  FROM {name}_typed)
"""


_CHECKED_EVENTS_SQL = "WITH " + _checked_sql()


@register(
    "valid_events",
    _CHECKED_EVENTS_SQL
    + """
SELECT t_id AS event_id, t_ts AS ts, t_user AS user_id, t_type AS event_type,
       CAST(CAST(t_value AS DECIMAL(12,2)) AS DOUBLE) AS value, props
FROM checked WHERE error IS NULL
""",
)
def valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the feed that pass every rule, typed and normalised."""
    from ledgerflow.operators.quality import good_rows

    good = good_rows(validated_events(spark, sf_dir))
    return good.withColumn("value", F.col("value").cast("double"))


@register(
    "quarantined_events",
    _CHECKED_EVENTS_SQL
    + """
SELECT event_id,
       json_object('event_id', event_id, 'ts', ts, 'user_id', user_id,
                   'event_type', event_type, 'value', value, 'props', props)::VARCHAR AS raw_row,
       error
FROM checked WHERE error IS NOT NULL
""",
)
def quarantined_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows with the original row as JSON and the first failing rule."""
    from ledgerflow.operators.quality import bad_rows

    from ledgerflow.operators.quality import validate

    feed = events_feed(spark, sf_dir).withColumn("_raw_id", F.col("event_id"))
    spec = events_spec()
    spec.extra_columns = ("_raw_id",)
    return bad_rows(validate(feed, spec), "_raw_id").withColumnRenamed("_raw_id", "event_id")


@register(
    "load_counters",
    _CHECKED_EVENTS_SQL
    + """
SELECT COUNT(*) AS rows_read,
       COUNT(*) FILTER (WHERE error IS NULL) AS rows_loaded,
       COUNT(*) FILTER (WHERE error IS NOT NULL) AS bad_rows
FROM checked
""",
)
def load_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Read / loaded / bad counters from the same single pass."""
    from ledgerflow.operators.quality import load_counters as counters

    return counters(validated_events(spark, sf_dir))


# --- M1 / M3: deduplication ------------------------------------------------------

_LI_KEYS = ["l_orderkey", "l_linenumber"]
_LI_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
    "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def _dedupe_sql(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in _LI_ORDER)
    return f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
  FROM lineitem) x
WHERE rn = 1
"""


@register("dedupe_first", _dedupe_sql("ASC"))
def dedupe_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M1: one line item per (order, line number), the first in column order."""
    from ledgerflow.operators.merge import dedupe

    li = _t(spark, sf_dir, "lineitem")
    return dedupe(li, _LI_KEYS, _LI_ORDER, "first", [c for c in li.columns if c not in _LI_KEYS])


@register("dedupe_last", _dedupe_sql("DESC"))
def dedupe_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 (dedupe part): one line item per key, the last in column order."""
    from ledgerflow.operators.merge import dedupe

    li = _t(spark, sf_dir, "lineitem")
    return dedupe(li, _LI_KEYS, _LI_ORDER, "last", [c for c in li.columns if c not in _LI_KEYS])


# --- M2 / M4 / M7: merges -----------------------------------------------------------

# The existing table holds orders before 1999, the increment
# orders from 1998 on (one overlapping year re-delivered with changed prices,
# as a lookback window re-reads recent rows).
TARGET_BEFORE = "1999-01-01 00:00:00"
SOURCE_FROM = "1998-01-01 00:00:00"
_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def _order_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    from ledgerflow.operators.merge import with_columns

    orders = _t(spark, sf_dir, "orders").select(*_ORDER_COLS)
    target = with_columns(
        R.where_between(orders, "o_orderdate", None, TARGET_BEFORE),
        {"o_day": X.day_of("o_orderdate"), "last_run_id": F.lit(1).cast("bigint")},
    )
    source = with_columns(
        R.where_between(orders, "o_orderdate", SOURCE_FROM, None),
        {
            "o_totalprice": F.col("o_totalprice") + F.lit(1.0),
            "o_day": X.day_of("o_orderdate"),
            "last_run_id": F.lit(2).cast("bigint"),
        },
    )
    return target, source


_VERSIONS_SQL = f"""
WITH target AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
         CAST(o_orderdate AS DATE) AS o_day, CAST(1 AS BIGINT) AS last_run_id
  FROM orders WHERE o_orderdate < TIMESTAMP '{TARGET_BEFORE}'),
source AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
         o_orderpriority, CAST(o_orderdate AS DATE) AS o_day, CAST(2 AS BIGINT) AS last_run_id
  FROM orders WHERE o_orderdate >= TIMESTAMP '{SOURCE_FROM}')
"""


@register(
    "upsert_orders",
    _VERSIONS_SQL
    + """
SELECT * FROM target t WHERE NOT EXISTS (SELECT 1 FROM source s WHERE s.o_orderkey = t.o_orderkey)
UNION ALL
SELECT * FROM source
""",
)
def upsert_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The increment replaces existing orders by key and adds new ones."""
    from ledgerflow.operators.merge import upsert

    target, source = _order_versions(spark, sf_dir)
    return upsert(target, source, ["o_orderkey"])


@register(
    "insert_if_absent",
    _VERSIONS_SQL
    + """
SELECT * FROM target
UNION ALL
SELECT * FROM source s WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.o_orderkey = s.o_orderkey)
""",
)
def insert_if_absent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: only orders whose key is new are added; existing ones stay untouched."""
    from ledgerflow.operators.merge import insert_if_absent as insert

    target, source = _order_versions(spark, sf_dir)
    return insert(target, source, ["o_orderkey"])


# --- M3 / X15: customer dimension ------------------------------------------------

# The existing dimension holds parts larger than size 25 under a
# seed name; the feed delivers parts up to size 40. Load times are parameters
# (the original uses now()); fixed here so both engines agree.
DIM_SEED_MIN_SIZE = 25
DIM_FEED_MAX_SIZE = 40
DIM_SEED_TIME = "2025-01-01 00:00:00"
DIM_LOAD_TIME = "2026-01-01 00:00:00"


@register(
    "customer_dim",
    f"""
WITH feed AS (
  SELECT p_partkey AS customer_id,
         CASE WHEN p_name IS NULL OR regexp_replace(p_name, {_WS}, '', 'g') = '' THEN []::VARCHAR[]
              ELSE string_split_regex(regexp_replace(p_name, {_WS}, '', 'g'), '\\s+') END AS parts,
         lower(replace(p_brand, '#', '')) || '@example.com' AS email
  FROM part WHERE p_size <= {DIM_FEED_MAX_SIZE}),
src AS (
  SELECT customer_id,
         CASE WHEN len(parts) >= 1 THEN parts[1] ELSE 'Unknown' END AS first_name,
         CASE WHEN len(parts) >= 2 THEN array_to_string(parts[2:], ' ') ELSE 'Unknown' END AS last_name,
         email
  FROM feed),
tgt AS (
  SELECT p_partkey AS customer_id, 'Seed' AS first_name, 'User' AS last_name,
         'seed.user@example.com' AS email, TIMESTAMP '{DIM_SEED_TIME}' AS created_at
  FROM part WHERE p_size > {DIM_SEED_MIN_SIZE})
SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
       CASE WHEN s.customer_id IS NOT NULL THEN s.first_name ELSE t.first_name END AS first_name,
       CASE WHEN s.customer_id IS NOT NULL THEN s.last_name ELSE t.last_name END AS last_name,
       CASE WHEN s.customer_id IS NOT NULL THEN s.email ELSE t.email END AS email,
       CASE WHEN t.customer_id IS NOT NULL THEN t.created_at ELSE TIMESTAMP '{DIM_LOAD_TIME}' END AS created_at
FROM src s FULL OUTER JOIN tgt t ON s.customer_id = t.customer_id
""",
)
def customer_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names split into first/last and merged into a dimension that
    keeps each row's first ``created_at``."""
    from ledgerflow.operators.merge import dedupe, merge_keep

    part = _t(spark, sf_dir, "part")
    feed = part.where(F.col("p_size") <= DIM_FEED_MAX_SIZE).select(
        F.col("p_partkey").alias("customer_id"),
        F.col("p_name").alias("full_name"),
        F.concat(F.lower(F.regexp_replace("p_brand", "#", "")), F.lit("@example.com")).alias("email"),
    )
    # Last delivery of a key wins (keys are unique here; the step is what a feed needs).
    feed = dedupe(feed, ["customer_id"], ["full_name", "email"], "last")
    first, last = X.split_name("full_name")
    src = feed.select("customer_id", first.alias("first_name"), last.alias("last_name"), "email")
    seed = part.where(F.col("p_size") > DIM_SEED_MIN_SIZE).select(
        F.col("p_partkey").alias("customer_id"),
        F.lit("Seed").alias("first_name"),
        F.lit("User").alias("last_name"),
        F.lit("seed.user@example.com").alias("email"),
        F.lit(DIM_SEED_TIME).cast("timestamp_ntz").alias("created_at"),
    )
    return merge_keep(
        seed, src, ["customer_id"], ["created_at"], {"created_at": F.lit(DIM_LOAD_TIME).cast("timestamp_ntz")}
    )


# --- I1-I5: watermark and late data ------------------------------------------------

# The stored watermark of the events job and the lookback.
EVENTS_JOB = "events_feed"
EVENTS_WATERMARK = "2024-01-20 00:00:00"
LOOKBACK_HOURS = 24


def _events_cutoff(spark: SparkSession):
    from ledgerflow.operators.incremental import compute_cutoff, get_watermark, state_frame

    state = state_frame(spark, EVENTS_JOB, EVENTS_WATERMARK, "timestamp_ntz")
    return compute_cutoff(get_watermark(state, EVENTS_JOB), LOOKBACK_HOURS)


@register(
    "late_data_filter",
    "SELECT * FROM events WHERE ts IS NULL OR ts >= TIMESTAMP '2024-01-19 00:00:00'",
)
def late_data_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows at or after watermark - lookback; unparseable times pass."""
    from ledgerflow.operators.incremental import late_data_filter as late

    return late(_t(spark, sf_dir, "events"), "ts", _events_cutoff(spark))


@register(
    "next_watermark",
    _CHECKED_EVENTS_SQL
    + f"""
SELECT '{EVENTS_JOB}' AS job_name, max(t_ts) AS watermark
FROM checked WHERE error IS NULL AND (t_ts IS NULL OR t_ts >= TIMESTAMP '2024-01-19 00:00:00')
""",
)
def next_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Max event time of the rows a run accepts (late filter, then validation)."""
    from ledgerflow.operators.incremental import late_data_filter as late
    from ledgerflow.operators.incremental import next_watermark as nxt
    from ledgerflow.operators.quality import good_rows, validate

    feed = late(events_feed(spark, sf_dir), "ts", _events_cutoff(spark), "timestamp_ntz")
    accepted = good_rows(validate(feed, events_spec()))
    return nxt(accepted, "ts").select(F.lit(EVENTS_JOB).alias("job_name"), "watermark")


# --- Q1-Q5: data-quality checks -----------------------------------------------------

# Fixed value: the run whose influence Q4 measures (line items shipped in 1998).
DQ_RUN = 1998


@register(
    "dq_checks",
    f"""
WITH s AS (
  SELECT COUNT(*) AS total,
         (SELECT COUNT(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) d) AS distinct_total,
         COUNT(*) FILTER (WHERE year(l_shipdate) = {DQ_RUN}) AS influenced
  FROM lineitem),
c AS (SELECT COUNT(*) FILTER (WHERE c_acctbal <= 0) AS non_positive FROM customer)
SELECT 'min_rows_loaded_nonzero' AS check_name,
       total >= CASE WHEN total = 0 THEN 0 ELSE 1 END AS passed,
       CAST(total AS DOUBLE) AS metric,
       'Expected at least ' || CASE WHEN total = 0 THEN 0 ELSE 1 END || ' rows loaded, got ' || total AS details
FROM s
UNION ALL
SELECT 'no_duplicates_in_clean_transactions', total = distinct_total, CAST(total - distinct_total AS DOUBLE),
       'Total rows: ' || total || ', Distinct txn_id: ' || distinct_total FROM s
UNION ALL
SELECT 'no_non_positive_amounts_in_clean', non_positive = 0, CAST(non_positive AS DOUBLE),
       'Non-positive amount count: ' || non_positive FROM c
UNION ALL
SELECT 'recent_run_influenced_clean', CASE WHEN total > 0 THEN influenced > 0 ELSE TRUE END,
       CAST(influenced AS DOUBLE),
       'Expected at least some rows influenced by run_id={DQ_RUN}, got ' || influenced FROM s
""",
)
def dq_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 A5: the four checks; line items as the clean table, customer balances as amounts."""
    from ledgerflow.operators.quality import dq_checks as checks

    li = _t(spark, sf_dir, "lineitem").select(*_LI_KEYS, F.year("l_shipdate").alias("last_run_id"))
    balances = _t(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("amount"))
    return checks(li, _LI_KEYS, "amount", "last_run_id", DQ_RUN, F.count(F.lit(1)), amounts=balances)


# --- K1-K6: constraint report -------------------------------------------------------

# Fixed value: the allowed order statuses of the domain check.
ORDER_STATUSES = ["F", "O"]


@register(
    "constraint_report",
    """
SELECT 'orders' AS table_name, 'not_null' AS rule, 'o_orderkey' AS column_name,
       COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS violations FROM orders
UNION ALL SELECT 'orders', 'not_null', 'o_custkey', COUNT(*) FILTER (WHERE o_custkey IS NULL) FROM orders
UNION ALL SELECT 'orders', 'not_null', 'o_orderstatus', COUNT(*) FILTER (WHERE o_orderstatus IS NULL) FROM orders
UNION ALL SELECT 'orders', 'not_null', 'o_orderdate', COUNT(*) FILTER (WHERE o_orderdate IS NULL) FROM orders
UNION ALL SELECT 'orders', 'unique', 'o_orderkey',
  (SELECT COUNT(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING COUNT(*) > 1) d)
UNION ALL SELECT 'lineitem', 'unique', 'l_orderkey,l_linenumber',
  (SELECT COUNT(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1) d)
UNION ALL SELECT 'orders', 'foreign_key', 'o_custkey',
  (SELECT COUNT(*) FROM orders o WHERE o_custkey IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey))
UNION ALL SELECT 'lineitem', 'foreign_key', 'l_orderkey',
  (SELECT COUNT(*) FROM lineitem l WHERE l_orderkey IS NOT NULL
     AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
UNION ALL SELECT 'orders', 'domain', 'o_orderstatus',
  COUNT(*) FILTER (WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')) FROM orders
UNION ALL SELECT 'lineitem', 'precision', 'l_extendedprice',
  COUNT(*) FILTER (WHERE l_extendedprice IS NOT NULL
                   AND TRY_CAST(l_extendedprice AS DECIMAL(12,2)) IS NULL) FROM lineitem
""",
)
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NOT NULL, unique, foreign-key, domain and precision violations."""
    from ledgerflow.operators import quality as Q

    orders = _t(spark, sf_dir, "orders")
    lineitem = _t(spark, sf_dir, "lineitem")
    customer = _t(spark, sf_dir, "customer")
    return Q.violations_report(
        Q.single_pass_report(
            orders, "orders",
            not_null=["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate"],
            domains={"o_orderstatus": ORDER_STATUSES},
        ),
        Q.keys_report(lineitem, "lineitem", _LI_KEYS, "l_orderkey", orders, "orders", "o_orderkey"),
        Q.foreign_key_report(orders, "orders", "o_custkey", customer, "c_custkey"),
        Q.single_pass_report(lineitem, "lineitem", precision=["l_extendedprice"]),
    )


# --- X11 A2: daily totals -----------------------------------------------------------

@register(
    "daily_totals",
    """
SELECT CAST(ts AS DATE) AS day, event_type,
       CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value, COUNT(*) AS n_events
FROM events GROUP BY 1, 2
""",
)
def daily_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X11 A2: value and count per (day, event type)."""
    ev = _t(spark, sf_dir, "events").select(X.day_of("ts").alias("day"), "event_type", "value")
    return _as_double(R.grouped_totals(ev, ["day", "event_type"], "value", "total_value", "n_events"), "total_value")


# --- I9 P13: catch-up intervals -------------------------------------------------------

# A weekday 09:00 schedule over January-February 2024.
SCHEDULE_START = "2024-01-01"
SCHEDULE_END = "2024-02-29"
SCHEDULE_HOUR = 9
# The dates on which the backfill is called.
BACKFILL_DATES = ["2024-01-17 12:00:00", "2024-03-10 00:00:00", "2024-03-11 00:00:00"]


@register(
    "missing_intervals",
    f"""
WITH days AS (
  SELECT CAST(d AS DATE) AS run_date
  FROM generate_series(TIMESTAMP '{SCHEDULE_START}', TIMESTAMP '{SCHEDULE_END}', INTERVAL 1 DAY) g(d)
  WHERE isodow(d) <= 5)
SELECT run_date,
       CAST(run_date AS TIMESTAMP) + INTERVAL {SCHEDULE_HOUR} HOUR AS interval_start,
       CAST(run_date + CASE WHEN isodow(run_date) = 5 THEN 3 ELSE 1 END AS TIMESTAMP)
         + INTERVAL {SCHEDULE_HOUR} HOUR AS interval_end
FROM days
WHERE run_date NOT IN (SELECT DISTINCT CAST(ts AS DATE) FROM events WHERE ts IS NOT NULL)
""",
)
def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scheduled weekday intervals with no events yet, oldest first."""
    import datetime as dt

    from ledgerflow.operators.incremental import missing_intervals as missing
    from ledgerflow.operators.incremental import schedule_starts

    sched = schedule_starts(
        spark, dt.date.fromisoformat(SCHEDULE_START), dt.date.fromisoformat(SCHEDULE_END), SCHEDULE_HOUR
    )
    done = _t(spark, sf_dir, "events").where(F.col("ts").isNotNull()).select(X.day_of("ts").alias("run_date"))
    return missing(sched, done)


# --- X16 P12: text rewrite ----------------------------------------------------------

# The word replaced (first occurrence on every line) and its replacement.
REWRITE_FROM = "the"
REWRITE_TO = "THE"


@register(
    "rewrite_lines",
    f"""
SELECT doc_id, regexp_replace(text, '(?m)^([^\\n]*?){REWRITE_FROM}', '\\1{REWRITE_TO}', 'g') AS text
FROM documents
""",
)
def rewrite_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sed 's/the/THE/'`` on every line of every whole document."""
    docs = _t(spark, sf_dir, "documents")
    return docs.select("doc_id", X.replace_first_per_line("text", REWRITE_FROM, REWRITE_TO).alias("text"))


# --- S11: surrogate keys --------------------------------------------------------------

@register(
    "surrogate_keys",
    "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS surrogate_id FROM customer",
)
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gap-free ids in key order without a single-partition window."""
    from ledgerflow.operators.keys import assign_surrogate_keys

    cust = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return assign_surrogate_keys(cust, ["c_custkey"], "surrogate_id")


# --- J6 M5 M6: visible rows ---------------------------------------------------------

# Orders are tagged with a run per order year (1995 -> run 1);
# run 3 failed and the newest run is still running.
RUN_BASE_YEAR = 1994
FAILED_RUNS = [3]


@register(
    "visible_rows",
    f"""
WITH tagged AS (
  SELECT *, CAST(year(o_orderdate) - {RUN_BASE_YEAR} AS BIGINT) AS run_id FROM orders),
runs AS (SELECT DISTINCT run_id FROM tagged),
ledger AS (
  SELECT run_id, 1 AS event_seq, 'running' AS status FROM runs
  UNION ALL
  SELECT run_id, 2, CASE WHEN run_id IN ({", ".join(map(str, FAILED_RUNS))}) THEN 'failed' ELSE 'success' END
  FROM runs WHERE run_id < (SELECT max(run_id) FROM runs)),
cur AS (SELECT run_id, arg_max(status, event_seq) AS status FROM ledger GROUP BY run_id)
SELECT t.* FROM tagged t WHERE t.run_id IN (SELECT run_id FROM cur WHERE status = 'success')
""",
)
def visible_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only rows of runs whose newest ledger event is success are read."""
    from ledgerflow.operators import ledger as L

    tagged = _t(spark, sf_dir, "orders").withColumn(
        "run_id", (F.year("o_orderdate") - F.lit(RUN_BASE_YEAR)).cast("bigint")
    )
    runs = tagged.select("run_id").distinct()
    newest = runs.agg(F.max("run_id")).scalar()
    started = runs.select("run_id", F.lit(1).alias("event_seq"), F.lit(L.RUNNING).alias("status"))
    finished = runs.where(F.col("run_id") < newest).select(
        "run_id",
        F.lit(2).alias("event_seq"),
        F.when(F.col("run_id").isin(FAILED_RUNS), F.lit(L.FAILED)).otherwise(F.lit(L.SUCCESS)).alias("status"),
    )
    ledger = started.unionByName(finished)
    return L.visible(tagged, ledger, "run_id")


# --- P9 / P11: the whole load over the events feed --------------------------------

def _write_feed_csv(spark: SparkSession, sf_dir: str, path: str) -> None:
    """Land the events feed as CSV files (RFC 4180 quoting), as a producer would."""
    events_feed(spark, sf_dir).write.option("header", True).option("escape", '"').csv(path)


def _events_load_config(work: str, source: str):
    from ledgerflow.jobs.incremental_load import LoadConfig

    return LoadConfig(
        root=f"{work}/tables",
        source_path=source,
        spec=events_spec(),
        key="event_id",
        job_name=EVENTS_JOB,
        day_col="event_day",
        lookback_hours=LOOKBACK_HOURS,
        feed_columns=list(FEED_COLUMNS),
    )


_VALID_EVENTS_SELECT = """
SELECT t_id AS event_id, t_ts AS ts, t_user AS user_id, t_type AS event_type,
       CAST(CAST(t_value AS DECIMAL(12,2)) AS DOUBLE) AS value, props
FROM checked WHERE error IS NULL
"""


@register("stream_load", _CHECKED_EVENTS_SQL + _VALID_EVENTS_SELECT)
def stream_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed lands as several files, newest events first, and a
    file-stream query takes one file per trigger through the same
    validate/dedupe/upsert run; older rows that arrive later are loaded too,
    so the committed clean table equals the batch result."""
    from ledgerflow.jobs.incremental_load import read_clean
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming.file_load import run_available

    work = scratch_path(spark, "stream_load")
    landing = f"{work}/landing"
    feed = events_feed(spark, sf_dir)
    newest_first = feed.repartitionByRange(3, F.col("ts").desc_nulls_first())
    newest_first.write.option("header", True).option("escape", '"').csv(landing)
    cfg = _events_load_config(work, landing)
    run_available(spark, cfg, landing, f"{work}/checkpoint", max_files_per_trigger=1)
    clean = read_clean(spark, cfg)
    return clean.select(*[F.col(c).cast("double").alias(c) if c == "value" else F.col(c) for c in FEED_COLUMNS])


@register(
    "incremental_load",
    _CHECKED_EVENTS_SQL
    + f""",
valid AS ({_VALID_EVENTS_SELECT})
SELECT *, CASE WHEN ts >= (SELECT max(ts) FROM valid) - INTERVAL {LOOKBACK_HOURS} HOUR
               THEN CAST(2 AS BIGINT) ELSE CAST(1 AS BIGINT) END AS last_run_id
FROM valid
""",
)
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch load run twice on the same feed. The
    second run re-reads the lookback window before the watermark and upserts
    it, so exactly those rows carry the second run's id."""
    from ledgerflow.jobs.incremental_load import read_clean, run_load
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "incremental_load")
    feed = f"{work}/feed"
    _write_feed_csv(spark, sf_dir, feed)
    cfg = _events_load_config(work, feed)
    run_load(spark, cfg)
    run_load(spark, cfg)
    clean = read_clean(spark, cfg)
    cols = [F.col(c).cast("double").alias(c) if c == "value" else F.col(c) for c in FEED_COLUMNS]
    return clean.select(*cols, "last_run_id")


# --- P13: backfill of missing schedule intervals -----------------------------------

@register(
    "backfill_intervals",
    f"""
WITH e AS (SELECT CAST(ts - INTERVAL {SCHEDULE_HOUR} HOUR AS DATE) AS d, value FROM events WHERE ts IS NOT NULL),
a AS (SELECT CASE WHEN isodow(d) = 6 THEN d - 1 WHEN isodow(d) = 7 THEN d - 2 ELSE d END AS run_date, value FROM e)
SELECT run_date, COUNT(*) AS n_events, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS total_value
FROM a
WHERE run_date BETWEEN DATE '{SCHEDULE_START}' AND DATE '{SCHEDULE_END}'
GROUP BY run_date
""",
)
def backfill_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catch-up runs over the weekday 09:00 schedule on two dates: each
    computes the missing intervals that have ended by then and writes every one
    as its own partition; a third call finds nothing left to do."""
    import datetime as dt

    from ledgerflow.jobs import backfill
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "backfill")
    events = _t(spark, sf_dir, "events")
    start, end = dt.date.fromisoformat(SCHEDULE_START), dt.date.fromisoformat(SCHEDULE_END)
    for as_of in BACKFILL_DATES:
        backfill.run(spark, events, work, start, end, SCHEDULE_HOUR, dt.datetime.fromisoformat(as_of))
    done = spark.read.parquet(f"{work}/interval_totals").select("run_date", "n_events", "total_value")
    return _as_double(done, "total_value")


# --- P9: re-delivered rows, checks, preview ----------------------------------------

# The second feed delivers all events of this type again, each
# with one more unit of value.
REDELIVERED_TYPE = "purchase"
LONG_LOOKBACK_HOURS = 24 * 365 * 10
_AGAIN = f"(SELECT * REPLACE (value + 1.0 AS value) FROM events WHERE event_type = '{REDELIVERED_TYPE}')"
_TWO_FEEDS_SQL = (
    "WITH "
    + _checked_sql()
    + ","
    + _checked_sql(_AGAIN, "again")
    + """,
one AS (SELECT t_id AS event_id, t_ts AS ts, t_user AS user_id, t_type AS event_type,
               CAST(CAST(t_value AS DECIMAL(12,2)) AS DOUBLE) AS value, props, CAST(1 AS BIGINT) AS last_run_id
        FROM checked WHERE error IS NULL),
two AS (SELECT t_id AS event_id, t_ts AS ts, t_user AS user_id, t_type AS event_type,
               CAST(CAST(t_value AS DECIMAL(12,2)) AS DOUBLE) AS value, props, CAST(2 AS BIGINT) AS last_run_id
        FROM again WHERE error IS NULL)
"""
)


def _two_loads(spark: SparkSession, sf_dir: str):
    """Load the whole feed, then a second feed that re-delivers some keys changed."""
    import dataclasses

    from ledgerflow.jobs.incremental_load import run_load
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "two_loads")
    _write_feed_csv(spark, sf_dir, f"{work}/first")
    again = R.where_equals(_t(spark, sf_dir, "events"), event_type=REDELIVERED_TYPE)
    again = again.withColumn("value", F.col("value") + F.lit(1.0))
    again = again.select(*[F.col(c).cast("string").alias(c) for c in FEED_COLUMNS])
    again.write.option("header", True).option("escape", '"').csv(f"{work}/second")
    cfg = dataclasses.replace(_events_load_config(work, f"{work}/first"), lookback_hours=LONG_LOOKBACK_HOURS)
    run_load(spark, cfg)
    cfg = dataclasses.replace(cfg, source_path=f"{work}/second")
    run_load(spark, cfg)
    return cfg


@register(
    "redelivered_load",
    _TWO_FEEDS_SQL + "SELECT * FROM two UNION ALL SELECT * FROM one WHERE event_id NOT IN (SELECT event_id FROM two)",
)
def redelivered_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run writes only its own rows; the clean table shows the newest row of every key."""
    from ledgerflow.jobs.incremental_load import read_clean

    clean = read_clean(spark, _two_loads(spark, sf_dir))
    return _as_double(clean, "value").select(*FEED_COLUMNS, "last_run_id")


@register(
    "load_dq",
    _TWO_FEEDS_SQL
    + """,
runs AS (
  SELECT 1 AS run_id, (SELECT COUNT(*) FROM one) AS loaded, (SELECT COUNT(*) FROM one) AS total
  UNION ALL
  SELECT 2, (SELECT COUNT(*) FROM two),
         (SELECT COUNT(*) FROM (SELECT event_id FROM one UNION SELECT event_id FROM two)))
SELECT CAST(run_id AS BIGINT) AS run_id, 'min_rows_loaded_nonzero' AS check_name, TRUE AS passed,
       CAST(loaded AS DOUBLE) AS metric,
       'Expected at least ' || least(loaded, 1) || ' rows loaded, got ' || loaded AS details FROM runs
UNION ALL
SELECT run_id, 'no_duplicates_in_clean_transactions', TRUE, 0.0,
       'Total rows: ' || total || ', Distinct txn_id: ' || total FROM runs
UNION ALL
SELECT run_id, 'no_non_positive_amounts_in_clean', TRUE, 0.0, 'Non-positive amount count: 0' FROM runs
UNION ALL
SELECT run_id, 'recent_run_influenced_clean', TRUE, CAST(loaded AS DOUBLE),
       'Expected at least some rows influenced by run_id=' || run_id || ', got ' || loaded FROM runs
""",
)
def load_dq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The check rows that both runs recorded, taken over the whole clean table."""
    from ledgerflow.jobs.incremental_load import visible_table
    from ledgerflow.schemas import DQ_RESULTS

    fields = [f for f in DQ_RESULTS.fields if f.name != "run_id"]
    rows = visible_table(spark, _two_loads(spark, sf_dir), "dq", T.StructType(fields))
    return rows.select("run_id", "check_name", "passed", "metric", "details")


@register(
    "run_preview",
    _CHECKED_EVENTS_SQL
    + f"""
SELECT *, 'success' AS status, 'OK' AS message, TRUE AS in_order,
       (SELECT COUNT(*) FROM checked) AS rows_read,
       (SELECT COUNT(*) FROM checked WHERE error IS NULL) AS rows_loaded,
       (SELECT COUNT(*) FROM checked WHERE error IS NOT NULL) AS bad_rows
FROM ({_VALID_EVENTS_SELECT} ORDER BY ts, event_id LIMIT 10)
""",
)
def run_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run record and the first ten clean rows by event time."""
    from ledgerflow.jobs.incremental_load import preview_run, read_clean, run_load
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "run_preview")
    _write_feed_csv(spark, sf_dir, f"{work}/feed")
    cfg = _events_load_config(work, f"{work}/feed")
    result = run_load(spark, cfg)
    summary, first = preview_run(spark, cfg, result.run_id, read_clean(spark, cfg))
    record = summary.first()
    return _as_double(first, "value").select(
        *FEED_COLUMNS,
        *[F.lit(record[c]).alias(c) for c in ("status", "message", "rows_read", "rows_loaded", "bad_rows")],
        F.lit(record["started_at"] <= record["finished_at"]).alias("in_order"),
    )


# --- S1 S14: files with different headers -------------------------------------------

@register(
    "mixed_headers",
    _CHECKED_EVENTS_SQL
    + f"""
SELECT via, v.* FROM ({_VALID_EVENTS_SELECT}) v, (SELECT unnest(['batch', 'stream']) AS via)
""",
)
def mixed_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed in files of two column orders, loaded as a batch and as a stream."""
    from ledgerflow.jobs.incremental_load import read_clean, run_load
    from ledgerflow.session import scratch_path
    from ledgerflow.streaming.file_load import run_available

    work = scratch_path(spark, "mixed_headers")
    feed = events_feed(spark, sf_dir)
    known = F.col("event_type").isin(EVENT_TYPES[:1])
    for part in (feed.where(known), feed.where(known.isNull() | ~known).select(*reversed(FEED_COLUMNS))):
        part.write.mode("append").option("header", True).option("escape", '"').csv(f"{work}/landing")
    batch, stream = (_events_load_config(f"{work}/{via}", f"{work}/landing") for via in ("batch", "stream"))
    run_load(spark, batch)
    run_available(spark, stream, f"{work}/landing", f"{work}/checkpoint")
    out = [read_clean(spark, c).select(F.lit(v).alias("via"), *FEED_COLUMNS) for c, v in ((batch, "batch"), (stream, "stream"))]
    return _as_double(out[0].unionByName(out[1]), "value")


# --- X9 V2 V4: instants with offsets and broken times -------------------------------

# What the feed's producer writes as time, by the event's user.
_TS_FORMS = ["%s+05:45", "%sZ", "12:30", "2026", "", "%s"]


@register(
    "instant_events",
    "WITH "
    + _checked_sql(
        """(SELECT * REPLACE (CASE user_id % 6
             WHEN 0 THEN CAST(ts - INTERVAL '5 hours 45 minutes' AS VARCHAR)
             WHEN 2 THEN '12:30' WHEN 3 THEN '2026' WHEN 4 THEN '' ELSE CAST(ts AS VARCHAR) END AS ts) FROM events)"""
    )
    + "SELECT event_id, t_ts AS ts, error FROM checked",
)
def instant_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times with offsets become instants; a bare time, a bare year and a blank are rejected."""
    from ledgerflow.operators.quality import FeedSpec, validate

    forms = None
    number = F.col("user_id").cast("bigint") % len(_TS_FORMS)
    for k, form in enumerate(_TS_FORMS):
        text = F.format_string(form, "ts") if "%s" in form else F.lit(form)
        forms = F.when(number == k, text) if forms is None else forms.when(number == k, text)
    ts = F.when(F.col("ts").isNull() & number.isin(0, 1, 5), F.lit(None).cast("string")).otherwise(
        F.when(number.isNull(), F.col("ts")).otherwise(forms)
    )
    feed = events_feed(spark, sf_dir).withColumn("ts", ts).withColumn("_raw_id", F.col("event_id"))
    spec = FeedSpec(**{**events_spec().__dict__, "ts_type": "timestamp", "extra_columns": ("_raw_id",)})
    checked = validate(feed, spec)
    # the session zone is UTC, so the instant's wall clock is its UTC time
    return checked.select(F.col("_raw_id").alias("event_id"), F.col("ts").cast("timestamp_ntz").alias("ts"), "error")


# --- P10: the dimension job ----------------------------------------------------------

# Parts above this size come with an id that is no number; parts up
# to the other are delivered again under a new name.
BAD_ID_FROM_SIZE = 46
AGAIN_UP_TO_SIZE = 5


def _dimension_load(spark: SparkSession, sf_dir: str) -> str:
    import datetime as dt

    from ledgerflow.jobs import customer_dim as job
    from ledgerflow.session import scratch_path

    work = scratch_path(spark, "dimension_job")
    part = _t(spark, sf_dir, "part")
    key = F.when(F.col("p_size") >= BAD_ID_FROM_SIZE, F.concat(F.lit("P"), "p_partkey")).otherwise(F.col("p_partkey").cast("string"))
    email = F.concat(F.lit(" "), "p_brand", F.lit("@example.com"))
    feed = part.select(key.alias("customer_id"), F.col("p_name").alias("full_name"), email.alias("email"))
    again = part.where(F.col("p_size") <= AGAIN_UP_TO_SIZE).select(
        key.alias("customer_id"), F.concat(F.lit("Again "), "p_name").alias("full_name"), email.alias("email")
    )
    for name, rows in (("a", feed), ("b", again)):
        rows.write.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).csv(f"{work}/feed/{name}")
    job.run(spark, f"{work}/dim", f"{work}/feed/*", dt.datetime.fromisoformat(DIM_LOAD_TIME))
    return f"{work}/dim"


@register(
    "dimension_job",
    f"""
WITH f AS (SELECT *, CASE WHEN p_size <= {AGAIN_UP_TO_SIZE} THEN 'Again ' ELSE '' END || p_name AS full_name
           FROM part WHERE p_size < {BAD_ID_FROM_SIZE}),
w AS (SELECT *, string_split_regex(trim(full_name), '\\s+') AS parts FROM f)
SELECT CAST(p_partkey AS INTEGER) AS customer_id, coalesce(parts[1], 'Unknown') AS first_name,
       CASE WHEN len(parts) > 1 THEN array_to_string(parts[2:], ' ') ELSE 'Unknown' END AS last_name,
       ' ' || p_brand || '@example.com' AS email, TIMESTAMP '{DIM_LOAD_TIME}' AS created_at
FROM w
""",
)
def dimension_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: the job on a landed feed with bad ids and repeated keys; e-mails stay as given."""
    from ledgerflow.jobs import customer_dim as job

    dim = job.current_dimension(spark, _dimension_load(spark, sf_dir))
    return dim.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@register(
    "dimension_rejects",
    f"""
SELECT json_object('customer_id', 'P' || p_partkey, 'full_name', p_name,
                   'email', ' ' || p_brand || '@example.com')::VARCHAR AS raw_row,
       'validation error: invalid customer_id: P' || p_partkey AS error
FROM part WHERE p_size >= {BAD_ID_FROM_SIZE}
""",
)
def dimension_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: rows of the landed feed whose id is no number, with the reason."""
    from ledgerflow.jobs import customer_dim as job

    return job.rejected_rows(spark, _dimension_load(spark, sf_dir)).select("raw_row", "error")


# --- P12: the text job -----------------------------------------------------------------

@register(
    "rewrite_job",
    f"""
SELECT regexp_replace(line, '{REWRITE_FROM}', '{REWRITE_TO}') AS line, COUNT(*) AS n
FROM (SELECT unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents) GROUP BY 1
""",
)
def rewrite_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as text lines, rewritten by the job, counted by line."""
    from ledgerflow.jobs import rewrite_text
    from ledgerflow.session import scratch_path
    from ledgerflow.sources.files import write_lines

    work = scratch_path(spark, "rewrite_job")
    write_lines(_t(spark, sf_dir, "documents"), f"{work}/in", "text")
    out = rewrite_text.transform(spark, f"{work}/in", f"{work}/out", REWRITE_FROM, REWRITE_TO)
    return out.groupBy(F.col("value").alias("line")).agg(F.count(F.lit(1)).alias("n"))


from ledgerflow.plans import load_keys as _load_keys  # noqa: E402, F401  (registers its queries here)
