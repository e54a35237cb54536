"""Property tests (hypothesis) for merges and validation, on small random frames."""

import os

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerflow.jobs.transactions_load import transactions_spec
from ledgerflow.operators.merge import dedupe, insert_if_absent, upsert
from ledgerflow.operators.quality import bad_rows, good_rows, load_counters, validate
from ledgerflow.schemas import TRANSACTIONS_FEED_COLUMNS

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

keyed_rows = st.lists(st.tuples(st.integers(0, 6), st.integers(-5, 5)), max_size=12)


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k int, v int")


def _unique(rows):
    seen = {}
    for k, v in rows:
        seen.setdefault(k, v)
    return list(seen.items())


@SETTINGS
@given(target=keyed_rows, source=keyed_rows)
def test_upsert_idempotent_and_source_wins(spark, target, source):
    t, s = _frame(spark, _unique(target)), _frame(spark, _unique(source))
    once = upsert(t, s, ["k"])
    twice = upsert(once, s, ["k"])
    a = sorted(map(tuple, once.collect()))
    assert a == sorted(map(tuple, twice.collect()))
    expected = dict(_unique(target))
    expected.update(dict(_unique(source)))
    assert a == sorted(expected.items())


@SETTINGS
@given(target=keyed_rows, source=keyed_rows)
def test_insert_if_absent_keeps_target(spark, target, source):
    t, s = _frame(spark, _unique(target)), _frame(spark, _unique(source))
    out = dict(map(tuple, insert_if_absent(t, s, ["k"]).collect()))
    expected = dict(_unique(source))
    expected.update(dict(_unique(target)))
    assert out == expected


@SETTINGS
@given(rows=st.lists(st.tuples(st.integers(0, 4), st.integers(0, 1000)), max_size=15, unique_by=lambda r: r[1]))
def test_dedupe_keys_are_distinct_keys(spark, rows):
    df = spark.createDataFrame(rows, "k int, pos int")
    first = dict(map(tuple, dedupe(df, ["k"], ["pos"], "first").collect()))
    last = dict(map(tuple, dedupe(df, ["k"], ["pos"], "last").collect()))
    assert set(first) == set(last) == {k for k, _ in rows}
    for k in first:
        positions = [p for kk, p in rows if kk == k]
        assert first[k] == min(positions) and last[k] == max(positions)


field = st.one_of(
    st.none(), st.sampled_from(["", " ", "5", " 7 ", "abc", "0", "-1", "2500", "0.004", "1e3", "2500d", "nan",
                                "NPR", "npr ", "USD", "pos", " WEB", "atm", "2026-01-01T09:10:00+05:45", "junk"])
)


@SETTINGS
@given(rows=st.lists(st.tuples(*[field] * len(TRANSACTIONS_FEED_COLUMNS)), max_size=10))
def test_good_plus_bad_equals_read(spark, rows):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in TRANSACTIONS_FEED_COLUMNS))
    v = validate(df, transactions_spec())
    c = load_counters(v).first()
    assert c.rows_read == len(rows)
    assert good_rows(v).count() + bad_rows(v).count() == len(rows) == c.rows_loaded + c.bad_rows
    for r in good_rows(v).collect():
        assert r.txn_id and r.account_id is not None and r.amount is not None and r.amount >= 0
        assert r.currency == "NPR" and r.channel in ("pos", "web", "mobile") and r.ts_event is not None
