"""Row validation with quarantine, data-quality checks and constraint reports
(SURVEY §2.11: V1-V4, Q1-Q5, K1-K6, A7).

Validation is one ``select``: typed columns are parsed with ``try_cast`` and an
ordered ``CASE WHEN`` chain names the first failing rule, so good rows, bad
rows and the load counters all come from a single scan of the input.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import scalars as X

ERROR = "error"
RAW_ROW = "raw_row"
#: Array column for the fields of a feed row beyond its header.
SURPLUS = "_surplus"

# Rule messages of the feed validation ({} is the column name)
# and the names and detail texts of the four data-quality checks.
MSG_EMPTY = "{} is empty"
MSG_MUST_EXCEED = "{} must be > {}"
MSG_UNSUPPORTED = "unsupported {}: %s"
MSG_VALIDATION = "validation error: invalid {}: %s"
MSG_OUT_OF_RANGE = "validation error: {} out of range: %s"
DQ_MIN_ROWS = "min_rows_loaded_nonzero"
DQ_NO_DUPLICATES = "no_duplicates_in_clean_transactions"
DQ_NO_NON_POSITIVE = "no_non_positive_amounts_in_clean"
DQ_RUN_INFLUENCED = "recent_run_influenced_clean"
DQ_MIN_ROWS_DETAIL = "Expected at least %d rows loaded, got %d"
DQ_NO_DUPLICATES_DETAIL = "Total rows: %d, Distinct txn_id: %d"
DQ_NO_NON_POSITIVE_DETAIL = "Non-positive amount count: %d"
DQ_RUN_INFLUENCED_DETAIL = "Expected at least some rows influenced by run_id={}, got %d"


@dataclass(frozen=True)
class Rule:
    """A validation rule: ``fails`` marks a bad row, ``message`` says why."""

    name: str
    fails: Column
    message: Column


@dataclass
class FeedSpec:
    """How a text feed becomes typed rows: the validation rules of a load.

    ``id_col`` must be non-blank; ``int_cols`` parse as INT; ``number_col`` as a
    plain number that must exceed ``min_exclusive`` and fit ``DECIMAL(12,2)``;
    ``ts_col`` as a timestamp (``ts_type``); ``domains`` are normalised (upper
    or lower case) and checked against allowed values, in the given order.
    """

    id_col: str
    int_cols: Sequence[str]
    number_col: str
    ts_col: str | None
    domains: Sequence[tuple[str, Sequence[str], str]]  # (column, allowed, "upper"|"lower")
    min_exclusive: float = 0.0
    ts_type: str = "timestamp"
    raw_columns: Sequence[str] | None = None
    extra_columns: Sequence[str] = field(default_factory=tuple)
    surplus_col: str | None = None


def typed_columns(spec: FeedSpec) -> dict[str, Column]:
    """Normalised, typed value of every feed column (NULL where it does not parse)."""
    out: dict[str, Column] = {spec.id_col: X.strip(spec.id_col)}
    for c in spec.int_cols:
        out[c] = X.to_int(c)
    if spec.ts_col:
        out[spec.ts_col] = X.to_instant(spec.ts_col, spec.ts_type)
    out[spec.number_col] = X.to_double(spec.number_col)
    for c, _allowed, case in spec.domains:
        out[c] = X.upper_stripped(c) if case == "upper" else X.lower_stripped(c)
    return out


def feed_rules(spec: FeedSpec, t: Mapping[str, Column]) -> list[Rule]:
    """The ordered rules; the first failing one is the row's error."""
    rules = [
        Rule(
            "id_blank",
            t[spec.id_col].isNull() | (t[spec.id_col] == ""),
            F.lit(MSG_EMPTY.format(spec.id_col)),
        )
    ]
    for c in spec.int_cols:
        rules.append(
            Rule(f"{c}_int", t[c].isNull(), X.message(MSG_VALIDATION.format(c), F.col(c)))
        )
    num = t[spec.number_col]
    rules.append(
        Rule(
            f"{spec.number_col}_number",
            num.isNull(),
            X.message(MSG_VALIDATION.format(spec.number_col), F.col(spec.number_col)),
        )
    )
    bound = spec.min_exclusive
    bound_txt = str(int(bound)) if float(bound).is_integer() else str(bound)
    rules.append(
        Rule(
            f"{spec.number_col}_positive",
            num <= F.lit(bound),
            F.lit(MSG_MUST_EXCEED.format(spec.number_col, bound_txt)),
        )
    )
    for c, allowed, _case in spec.domains:
        rules.append(
            Rule(
                f"{c}_domain",
                t[c].isNull() | ~t[c].isin(list(allowed)),
                X.message(MSG_UNSUPPORTED.format(c), t[c]),
            )
        )
    # Rows that pass the feed's own rules but that no table could hold.
    if spec.ts_col:
        rules.append(
            Rule(
                f"{spec.ts_col}_ts",
                t[spec.ts_col].isNull(),
                X.message(MSG_VALIDATION.format(spec.ts_col), F.col(spec.ts_col)),
            )
        )
    rules.append(
        Rule(
            f"{spec.number_col}_range",
            F.isnan(num) | (F.abs(num) == F.lit(float("inf"))) | X.to_money(num).isNull(),
            X.message(MSG_OUT_OF_RANGE.format(spec.number_col), F.col(spec.number_col)),
        )
    )
    return rules


def first_error(rules: Sequence[Rule]) -> Column:
    """``CASE WHEN r1 THEN m1 WHEN r2 THEN m2 ... END``: NULL for a good row."""
    expr = None
    for r in rules:
        expr = F.when(r.fails, r.message) if expr is None else expr.when(r.fails, r.message)
    return expr


def validate(df: DataFrame, spec: FeedSpec) -> DataFrame:
    """V1-V3: one pass adding typed columns, ``error`` and the original row as JSON.

    Output columns: the typed feed columns (money rounded HALF_UP to
    ``DECIMAL(12,2)``), ``extra_columns`` passed through, ``error`` (NULL when
    good) and ``raw_row`` (JSON of the original text columns, NULLs kept, and of
    the surplus fields where there are any).

    Parsing happens once, in a first projection; the rule chain then only
    compares the parsed columns. (Catalyst keeps the two projections apart
    because collapsing them would repeat the parsing in every branch.)
    """
    own = [spec.surplus_col] if spec.surplus_col else []
    raw_cols = list(spec.raw_columns or [c for c in df.columns if c not in (*spec.extra_columns, *own)])
    parsed = typed_columns(spec)
    staged = df.select(
        *[F.col(c) for c in raw_cols],
        *[F.col(c) for c in spec.extra_columns if c not in raw_cols],
        *[F.col(c) for c in own],
        *[expr.alias(_TYPED + c) for c, expr in parsed.items()],
    )
    t = {c: F.col(_TYPED + c) for c in parsed}
    rules = feed_rules(spec, t)
    typed = []
    for c in raw_cols:
        if c == spec.number_col:
            typed.append(X.to_money(t[c]).alias(c))
        elif c in t:
            typed.append(t[c].alias(c))
        else:
            typed.append(F.col(c))
    checked = staged.withColumn(_ERROR, first_error(rules))
    raw = X.row_to_json(raw_cols)
    if own:  # surplus fields have no name: they are the JSON member "null", as json.dumps writes the key None
        beyond = F.col(own[0])
        raw = F.when(beyond.isNull(), raw).otherwise(X.row_to_json(raw_cols, null=beyond))
    return checked.select(
        *typed,
        *[F.col(c) for c in spec.extra_columns],
        F.col(_ERROR).alias(ERROR),
        F.when(F.col(_ERROR).isNotNull(), raw).alias(RAW_ROW),
    )


_TYPED = "__typed_"
_ERROR = "__error"


def _emit_where(df: DataFrame, cond: Column, cols: Sequence[Column]) -> DataFrame:
    """Rows for which ``cond`` holds, emitted by a generator (0 or 1 row per input).

    A plain ``where`` on the error column would be pushed by Catalyst through
    the parsing projection, which then runs twice (once in the filter, once
    for the output). Exploding a one-element array that is NULL for rejected
    rows keeps the split above the projection, so each value is parsed once;
    the generator stays inside whole-stage codegen.
    """
    return df.select(F.explode(F.when(cond, F.array(F.struct(*cols)))).alias("_row")).select("_row.*")


def good_rows(validated: DataFrame) -> DataFrame:
    """V3: rows without an error, error and raw JSON dropped."""
    cols = [F.col(c) for c in validated.columns if c not in (ERROR, RAW_ROW)]
    return _emit_where(validated, F.col(ERROR).isNull(), cols)


def bad_rows(validated: DataFrame, id_col: str | None = None) -> DataFrame:
    """V3: quarantined rows: the original row as JSON and the first failing rule."""
    cols = ([F.col(id_col)] if id_col else []) + [F.col(RAW_ROW), F.col(ERROR)]
    return _emit_where(validated, F.col(ERROR).isNotNull(), cols)


def load_counters(validated: DataFrame) -> DataFrame:
    """Rows read, loaded (good) and bad in one aggregate."""
    err = F.col(ERROR)
    return validated.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(err.isNull()).alias("rows_loaded"),
        F.count_if(err.isNotNull()).alias("bad_rows"),
    )


# --- Q: data-quality checks ---------------------------------------------------------

DQ_COLUMNS = ["check_name", "passed", "metric", "details"]


def dq_checks(
    clean: DataFrame,
    key_cols: Sequence[str],
    amount_col: str,
    run_col: str,
    run_id,
    rows_loaded: int | Column,
    amounts: DataFrame | None = None,
    approximate: bool = False,
) -> DataFrame:
    """Q1-Q5: the four checks of a load as four rows ``(check_name, passed, metric, details)``.

    ``approximate=True`` counts distinct keys with ``approx_count_distinct``
    (HyperLogLog, a few KB of state per task, no shuffle of the keys) instead
    of the exact count; the exact count is the default.

    * ``min_rows_loaded_nonzero``: expected ``0 if loaded == 0 else 1`` (as in
      the original job this check cannot fail; kept for the record);
    * ``no_duplicates_in_clean_transactions``: ``count - count(distinct key)``;
    * ``no_non_positive_amounts_in_clean``: ``count_if(amount <= 0)``;
    * ``recent_run_influenced_clean``: ``count_if(run_col = run_id)`` must be
      positive when anything was loaded.

    The three table checks share one aggregate pass over ``clean``. ``amounts``
    lets the non-positive check read another frame (then it is a second
    aggregate, unioned). The caller records the rows, then raises if any
    ``passed`` is false.
    """
    # ``rows_loaded`` is the run's counter, or an aggregate over ``clean``.
    loaded_expr = F.lit(int(rows_loaded)) if isinstance(rows_loaded, int) else rows_loaded
    keys = [F.col(k) for k in key_cols]
    own_amounts = amounts is None
    stats = clean.agg(
        loaded_expr.cast("bigint").alias("loaded"),
        F.count(F.lit(1)).alias("total"),
        (
            F.approx_count_distinct(keys[0] if len(keys) == 1 else F.struct(*keys))
            if approximate
            else F.count_distinct(*keys)
        ).alias("distinct_total"),
        F.count_if(F.col(run_col) == F.lit(run_id)).alias("influenced"),
        *([F.count_if(F.col(amount_col) <= 0).alias("non_positive")] if own_amounts else []),
    )
    if own_amounts:
        return dq_report(stats, run_id)
    extra = amounts.agg(F.count_if(F.col(amount_col) <= 0).alias("non_positive"))
    # two one-row aggregates; the check on the other frame is a row of its own
    main = dq_report(stats.withColumn("non_positive", F.lit(0).cast("bigint")), run_id, [0, 1, 3])
    zeros = [F.lit(0).cast("bigint").alias(c) for c in ("loaded", "total", "distinct_total", "influenced")]
    return main.unionByName(dq_report(extra.select(*zeros, "non_positive"), run_id, [2]))


def dq_report(stats: DataFrame, run_id, checks: Sequence[int] = (0, 1, 2, 3)) -> DataFrame:
    """The check rows for one row of counts: loaded, total, distinct_total, influenced, non_positive.

    The counts may come from a pass over the table or from totals kept run by run.
    """
    loaded, total, distinct = F.col("loaded"), F.col("total"), F.col("distinct_total")
    expected = F.when(loaded == 0, F.lit(0)).otherwise(F.lit(1))
    dup = total - distinct
    rows = [
        (DQ_MIN_ROWS, loaded >= expected, loaded, F.format_string(DQ_MIN_ROWS_DETAIL, expected, loaded)),
        (DQ_NO_DUPLICATES, dup == 0, dup, F.format_string(DQ_NO_DUPLICATES_DETAIL, total, distinct)),
        (
            DQ_NO_NON_POSITIVE, F.col("non_positive") == 0, F.col("non_positive"),
            F.format_string(DQ_NO_NON_POSITIVE_DETAIL, F.col("non_positive")),
        ),
        (
            DQ_RUN_INFLUENCED, F.when(loaded > 0, F.col("influenced") > 0).otherwise(F.lit(True)), F.col("influenced"),
            F.format_string(DQ_RUN_INFLUENCED_DETAIL.format(run_id), F.col("influenced")),
        ),
    ]
    named = [
        F.struct(F.lit(name).alias("check_name"), passed.alias("passed"), metric.cast("double").alias("metric"), details.alias("details"))
        for name, passed, metric, details in (rows[i] for i in checks)
    ]
    return stats.select(F.inline(F.array(*named)))


# --- K: constraint checks -------------------------------------------------------------

REPORT_COLUMNS = ["table_name", "rule", "column_name", "violations"]


def _report_row(table: str, rule: str, column: str, violations: Column) -> list[Column]:
    return [F.lit(table), F.lit(rule), F.lit(column), violations.cast("bigint")]


def not_null_report(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """K1: NULL count of every column, one scan."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [F.struct(*[x.alias(n) for x, n in zip(_report_row(table, "not_null", c, F.col(c)), REPORT_COLUMNS)]) for c in columns]
    return agg.select(F.inline(F.array(*rows)))


def unique_report(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """K2: number of key values occurring more than once."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return dup.agg(F.count(F.lit(1)).alias("v")).select(
        *[x.alias(n) for x, n in zip(_report_row(table, "unique", ",".join(keys), F.col("v")), REPORT_COLUMNS)]
    )


def foreign_key_report(
    child: DataFrame, table: str, fk: str, parent: DataFrame, pk: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent (left anti join).

    Child rows are first counted per key value (partial aggregation on the
    map side), so a foreign key shared by a third of the child rows reaches
    the join as one row; the anti join then sees distinct values only.
    """
    per_key = (
        child.where(F.col(fk).isNotNull())
        .groupBy(F.col(fk).alias("_k"))
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    orphans = per_key.join(parent.select(F.col(pk).alias("_k")), "_k", "left_anti")
    return orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("v")).select(
        *[x.alias(n) for x, n in zip(_report_row(table, "foreign_key", fk, F.col("v")), REPORT_COLUMNS)]
    )


def keys_report(
    child: DataFrame, child_table: str, child_keys: Sequence[str], fk: str, parent: DataFrame, parent_table: str, pk: str
) -> DataFrame:
    """K2 of two tables and K3 between them, each table scanned once.

    ``fk`` is one of ``child_keys``. Child rows are counted per key and then per
    ``fk``, parents per ``pk``, all with a map-side partial step, so both sides of
    the full outer join have every key once and no key is hot. Three report rows.
    """
    per_key = child.groupBy(*child_keys).agg(F.count(F.lit(1)).alias("_n"))
    per_fk = per_key.groupBy(F.col(fk).alias("_k")).agg(
        F.sum("_n").alias("_rows"), F.count_if(F.col("_n") > 1).alias("_dups")
    )
    parents = parent.groupBy(F.col(pk).alias("_p")).agg(F.count(F.lit(1)).alias("_pn"))
    both = per_fk.join(parents, F.col("_k") == F.col("_p"), "full_outer")
    orphan = F.col("_k").isNotNull() & F.col("_pn").isNull()
    totals = both.agg(
        F.count_if(F.col("_pn") > 1).alias("_parent"),
        F.coalesce(F.sum("_dups"), F.lit(0)).alias("_child"),
        F.coalesce(F.sum(F.when(orphan, F.col("_rows"))), F.lit(0)).alias("_orphans"),
    )
    rows = [
        _report_row(parent_table, "unique", pk, F.col("_parent")),
        _report_row(child_table, "unique", ",".join(child_keys), F.col("_child")),
        _report_row(child_table, "foreign_key", fk, F.col("_orphans")),
    ]
    return totals.select(F.inline(F.array(*[F.struct(*[x.alias(n) for x, n in zip(r, REPORT_COLUMNS)]) for r in rows])))


def domain_report(df: DataFrame, table: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """K4: values outside the allowed set (NULL passes, as in a CHECK)."""
    c = F.col(column)
    return df.agg(F.count_if(c.isNotNull() & ~c.isin(list(allowed))).alias("v")).select(
        *[x.alias(n) for x, n in zip(_report_row(table, "domain", column, F.col("v")), REPORT_COLUMNS)]
    )


def precision_report(df: DataFrame, table: str, column: str) -> DataFrame:
    """K5: values that do not fit ``NUMERIC(12,2)``."""
    return df.agg(F.count_if(~X.fits_money(column)).alias("v")).select(
        *[x.alias(n) for x, n in zip(_report_row(table, "precision", column, F.col("v")), REPORT_COLUMNS)]
    )


def single_pass_report(
    df: DataFrame,
    table: str,
    not_null: Sequence[str] = (),
    domains: Mapping[str, Sequence[str]] | None = None,
    precision: Sequence[str] = (),
) -> DataFrame:
    """K1 + K4 + K5 fused: every per-row rule of one table in a single aggregate scan."""
    domains = dict(domains or {})
    checks: list[tuple[str, str, Column]] = []
    for c in not_null:
        checks.append(("not_null", c, F.col(c).isNull()))
    for c, allowed in domains.items():
        checks.append(("domain", c, F.col(c).isNotNull() & ~F.col(c).isin(list(allowed))))
    for c in precision:
        checks.append(("precision", c, ~X.fits_money(c)))
    agg = df.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, _, cond) in enumerate(checks)])
    rows = [
        F.struct(*[x.alias(n) for x, n in zip(_report_row(table, rule, c, F.col(f"_v{i}")), REPORT_COLUMNS)])
        for i, (rule, c, _) in enumerate(checks)
    ]
    return agg.select(F.inline(F.array(*rows)))


def violations_report(*parts: DataFrame) -> DataFrame:
    """K6: union of the individual reports."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
