"""Input columns named like any helper of a stage come back with their own values."""

import pytest

from ledgerflow.llm import decontaminate, histogram_sort, mix, ngram_join, quality_rules
from ledgerflow.llm.common import prepare

NAMES = """row id key tkey root again empty copy turn _id _key _again _size _spans _text_key _empty _null _source spans source_name
    name words win at n offset block begin end times taken target src first start bucket sid component_id n_links item items text_key
    verdict kept label _verdict i rows _range _row n_words n_hit contaminated no_id r l k uid hits""".split()
ITEM = " ".join(f"item{k}" for k in range(20))


@pytest.fixture()
def docs(spark, make_docs):
    prepare(spark)
    prose = lambda i: " ".join(f"word{i}x{k} is" for k in range(40)) + "."
    rows = [(i, prose(i), "en", "ab"[i % 2]) for i in range(8)] + [(20, prose(1), "en", "b"), (21, prose(2) + " " + ITEM), (None, prose(30))]
    rows += [(22, prose(22), None, None), (23, prose(23)), (23, prose(23)), (24, None), (25, "")]
    df = make_docs(rows)
    return df.select("*", *((df["doc_id"] * 1000 + k).alias(name) for k, name in enumerate(NAMES)))


def unchanged(docs, out, but=()):
    """Every row of ``out`` is a row of ``docs``, apart from the columns ``but``."""
    columns = [c for c in docs.columns if c not in but]
    assert out.columns[: len(docs.columns)] == docs.columns
    have = {tuple(r[c] for c in columns) for r in docs.collect()}
    got = [tuple(r[c] for c in columns) for r in out.collect()]
    assert got and set(got) <= have
    return got


def test_quality_rules(docs, make_labels):
    unchanged(docs, quality_rules.keep_content(docs, make_labels([])))


def test_keep_one(docs):
    got = unchanged(docs, ngram_join.keep_one(docs))
    assert sorted(r[0] for r in got if r[0] is not None) == [*range(8), 21, 22, 23, 24, 25]  # 20 goes with 1; 21 is just below 0.8


def test_drop_contaminated(docs, spark):
    bench = spark.createDataFrame([(1, ITEM, 5)], "item_id long, text string, doc_id int")
    assert 21 not in {r[0] for r in unchanged(docs, decontaminate.drop_contaminated(docs, bench))}


def test_mixed_documents(docs):
    got = unchanged(docs, mix.mixed_documents(docs), ("text", "n_chars"))
    assert len(got) >= 10


def test_shard(docs):
    out = histogram_sort.shard(docs)
    assert len(unchanged(docs, out)) == docs.count() and out.columns[-3:] == ["size", "shard", "slot"]
    clash = docs.withColumn("slot", docs["doc_id"]).withColumn("size", docs["doc_id"]).withColumn("shard", docs["doc_id"])
    assert histogram_sort.shard(clash).columns == out.columns
