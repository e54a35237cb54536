import os

from ledgerflow.llm import common


def test_release_removes_what_was_written_since_the_mark(spark):
    common.prepare(spark)
    first = common.materialize(spark.range(5), "first")
    mark = common.written()
    second = common.materialize(spark.range(7), "second")
    folders = [df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/") for df in (first, second)]
    assert all(os.path.isdir(f) for f in folders) and second.count() == 7
    assert common.release(spark, mark) == 1 and common.written() == mark
    assert [os.path.exists(f) for f in folders] == [True, False] and first.count() == 5


def test_packed_keeps_every_column(make_docs):
    docs = make_docs([(1, "a"), (None, None)], extra=True).selectExpr("*", "5 AS `row`", "6 AS id")
    back = common.packed(docs).select("row.*")
    assert back.columns == docs.columns and sorted(map(str, back.collect())) == sorted(map(str, docs.collect()))
