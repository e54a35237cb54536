"""Deduplication and merge operators: semantics and properties."""

from pyspark.sql import functions as F

from ledgerflow.operators.merge import dedupe, insert_if_absent, merge_keep, upsert
from ledgerflow.operators.keys import assign_surrogate_keys


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_dedupe_first_and_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), ("a", 3, "w")], "k string, pos int, v string")
    assert rows(dedupe(df, ["k"], ["pos"], "first"), "k", "v") == [("a", "x"), ("b", "z")]
    assert rows(dedupe(df, ["k"], ["pos"], "last"), "k", "v") == [("a", "w"), ("b", "z")]
    # output keys = distinct keys
    assert dedupe(df, ["k"], ["pos"]).count() == df.select("k").distinct().count()


def test_dedupe_hot_key(spark):
    """A key holding most rows is reduced by the partial aggregate."""
    df = spark.range(0, 20000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), F.col("id").alias("pos")
    )
    out = dedupe(df, ["k"], ["pos"], "last")
    assert out.where("k = 0").first()["pos"] == 19998
    assert out.count() == df.select("k").distinct().count()


def test_upsert_replaces_and_keeps(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k int, v string, n int")
    s = spark.createDataFrame([(2, None, 21), (3, "c", 30)], "k int, v string, n int")
    out = upsert(t, s, ["k"])
    assert rows(out, "k", "v", "n") == [(1, "a", 10), (2, None, 21), (3, "c", 30)]
    # idempotent
    assert rows(upsert(out, s, ["k"]), "k", "v", "n") == rows(out, "k", "v", "n")


def test_insert_if_absent(spark):
    t = spark.createDataFrame([(1, "seed")], "k int, v string")
    s = spark.createDataFrame([(1, "new"), (2, "two")], "k int, v string")
    assert rows(insert_if_absent(t, s, ["k"]), "k", "v") == [(1, "seed"), (2, "two")]


def test_merge_keep_created_at(spark):
    t = spark.createDataFrame([(1, "old", "2025-01-01"), (9, "keep", "2025-01-02")], "k int, v string, created_at string")
    s = spark.createDataFrame([(1, "new"), (2, "two")], "k int, v string")
    out = merge_keep(t, s, ["k"], ["created_at"], {"created_at": F.lit("2026-01-01")})
    assert rows(out, "k", "v", "created_at") == [
        (1, "new", "2025-01-01"), (2, "two", "2026-01-01"), (9, "keep", "2025-01-02")
    ]


def test_surrogate_keys_consecutive_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    out = assign_surrogate_keys(df, ["k"], "sid", start=100, num_partitions=7)
    got = [(r.k, r.sid) for r in out.orderBy("k").collect()]
    assert got == [(k, 100 + k) for k in range(5000)]


def test_surrogate_keys_split_a_hot_value(spark):
    """A value held by most rows is spread over several range partitions."""
    df = spark.range(0, 6000).select(F.when(F.col("id") < 4000, F.lit(7)).otherwise(F.col("id")).alias("k"))
    out = assign_surrogate_keys(df, ["k"], "sid", num_partitions=6)
    ids = sorted(r.sid for r in out.collect())
    assert ids == list(range(1, 6001))
    hot = out.where("k = 7")
    assert sorted(r.sid for r in hot.collect()) == list(range(1, 4001))
