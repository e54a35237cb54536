import pytest

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source) tuples."""

    def make(rows, extra=False):
        full = [
            (r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1]) if r[1] is not None else None)
            for r in rows
        ]
        df = spark.createDataFrame(full, DOC_SCHEMA)
        if extra:  # names that the operators use themselves
            for c in ("kept", "n", "size", "shard", "words", "tkey", "x", "label", "score", "sid", "key"):
                df = df.withColumn(c, df["doc_id"] * 0)
        return df

    return make


@pytest.fixture()
def make_labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")

    return make
