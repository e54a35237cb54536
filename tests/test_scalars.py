"""Scalar functions on hand-made edge rows."""

from pyspark.sql import functions as F

from ledgerflow.functions import scalars as X
from ledgerflow.operators import relational as R


def one(spark, col, value, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(col.alias("out")).first()["out"]


def test_split_name(spark):
    df = spark.createDataFrame([("",), ("Cher",), ("  A   B  C ",), (None,), ("Aarav Shrestha",), ("\tX\nY ",)], "n string")
    first, last = X.split_name("n")
    rows = [(r[0], r[1]) for r in df.select(first, last).collect()]
    assert rows == [
        ("Unknown", "Unknown"), ("Cher", "Unknown"), ("A", "B C"), ("Unknown", "Unknown"),
        ("Aarav", "Shrestha"), ("X", "Y"),
    ]


def test_strip_removes_tabs_and_newlines(spark):
    assert one(spark, X.strip("v"), "\t npr \n") == "npr"
    assert one(spark, X.upper_stripped("v"), " npr ") == "NPR"
    assert one(spark, X.lower_stripped("v"), " WEB") == "web"


def test_to_int(spark):
    assert one(spark, X.to_int("v"), " 5 ") == 5
    for bad in ["abc", "5.0", "99999999999", "", None]:
        assert one(spark, X.to_int("v"), bad) is None


def test_to_double_rejects_suffixes(spark):
    assert one(spark, X.to_double("v"), "2500") == 2500.0
    assert one(spark, X.to_double("v"), "-1.5e2") == -150.0
    for bad in ["2500d", "abc", "nan", "inf", "", None, "1_0"]:
        assert one(spark, X.to_double("v"), bad) is None


def test_money_rounding_half_up(spark):
    assert str(one(spark, X.to_money("v"), 0.005, "double")) == "0.01"
    assert str(one(spark, X.to_money("v"), -0.005, "double")) == "-0.01"
    assert str(one(spark, X.to_money("v"), 0.004, "double")) == "0.00"
    assert one(spark, X.to_money("v"), 99999999999.0, "double") is None


def test_to_instant_honours_offset(spark):
    ts = one(spark, X.to_instant("v").cast("string"), "2026-01-05 00:05:00+05:45")
    assert ts == "2026-01-04 18:20:00"
    assert one(spark, X.to_instant("v"), "not a time") is None


def test_json_fields_missing_and_null(spark):
    df = spark.createDataFrame([('{"channel":"pos","note":null}',), ("{}",)], "m string")
    rows = df.select(X.json_field("m", "channel"), X.json_field("m", "note"), *X.json_fields("m", ["channel", "ip"])).collect()
    assert tuple(rows[0]) == ("pos", None, "pos", None)
    assert tuple(rows[1]) == (None, None, None, None)


def test_row_to_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(X.row_to_json(["x", "y"])).first()[0] == '{"x":"a","y":null}'


def test_replace_first_per_line(spark):
    df = spark.createDataFrame([("hello hello\nsay hello hello\r\nno\nhello",)], "t string")
    out = df.select(X.replace_first_per_line("t", "hello", "hello_airflow")).first()[0]
    assert out == "hello_airflow hello\nsay hello_airflow hello\r\nno\nhello_airflow"


def test_contains_all(spark):
    df = spark.createDataFrame([(1, ["vip", "salary"]), (2, []), (3, None), (4, ["salary"])], "id int, tags array<string>")
    got = lambda wanted: sorted(r.id for r in R.where_contains_all(df, "tags", wanted).collect())
    assert got(["vip"]) == [1]
    assert got(["vip", "salary"]) == [1]
    assert got([]) == [1, 2, 4]


def test_explode_counts_skips_empty_and_null(spark):
    df = spark.createDataFrame([(["a", "b"],), ([],), (None,), (["a"],)], "tags array<string>")
    rows = sorted(tuple(r) for r in R.explode_counts(df, "tags", "tag", "n").collect())
    assert rows == [("a", 2), ("b", 1)]


def test_rank_ties_share_rank_with_gap(spark):
    df = spark.createDataFrame([(1, "x", 10.0), (1, "y", 10.0), (1, "z", 5.0)], "c int, m string, v double")
    rows = sorted((r.m, r.r) for r in R.rank_within(df, ["c"], "v", "r").collect())
    assert rows == [("x", 1), ("y", 1), ("z", 3)]


def test_latest_per_key_is_deterministic_on_ties(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, 1, "c")], "k int, t int, p string")
    rows = sorted(tuple(r) for r in R.latest_per_key(df, ["k"], ["t", "p"], ["t", "p"]).collect())
    assert rows == [(1, 5, "b"), (2, 1, "c")]


def test_minus_hours_and_day(spark):
    df = spark.createDataFrame([("2026-01-05 04:20:00",)], "t string").select(F.col("t").cast("timestamp").alias("t"))
    r = df.select(X.minus_hours("t", 24).cast("string").alias("c"), X.day_of("t").cast("string").alias("d")).first()
    assert (r.c, r.d) == ("2026-01-04 04:20:00", "2026-01-05")


def test_semi_anti_and_domain_filters(spark):
    df = spark.createDataFrame([(1, "pos"), (2, "atm"), (3, None)], "k int, ch string")
    keys = spark.createDataFrame([(1,), (3,)], "k int")
    assert sorted(r.k for r in R.semi_join(df, keys, "k").collect()) == [1, 3]
    assert [r.k for r in R.anti_join(df, keys, "k").collect()] == [2]
    assert [r.k for r in R.where_in(df, "ch", ["pos", "web"]).collect()] == [1]
    assert R.row_count(df).first()["rows"] == 3
