"""Registered queries of this subpackage: one per operator, with the contract's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, histogram_sort, language_id, lm_score, mix, ngram_join, permuterm, prefix_trie, quality_rules, quality_score, secret_link, toxicity, warc
from .common import fold, prepare, read


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CRF line labels and base rules over all documents."""
    prepare(spark)
    return quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op1_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cross-entropy differences of all documents, good documents against all."""
    prepare(spark)
    target = lm_score.good_documents(read(spark, sf_dir, "labels"))
    return lm_score.score(read(spark, sf_dir, "documents"), target)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that the mix of sources takes."""
    prepare(spark)
    taken = mix.Mix(read(spark, sf_dir, "documents")).taken()
    return taken.select("doc_id", "size", "source_size", "target", "taken")


def op4_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    placed = histogram_sort.shard(docs.withColumn("text_crc32", crc), columns=["doc_id", "text_crc32"])
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op5_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages into a content-addressed archive and read its records back."""
    prepare(spark)
    found = warc.index(spark, warc.write(read(spark, sf_dir, "pages")))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in all documents."""
    prepare(spark)
    found = decontaminate.measure(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned outside the held-out fold."""
    prepare(spark)
    stats = quality_score.describe(read(spark, sf_dir, "documents"))
    model = quality_score.fit(stats, read(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0))
    return model.score(stats).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents, learned outside the held-out fold."""
    prepare(spark)
    docs = read(spark, sf_dir, "documents")
    model = language_id.fit(docs.where(fold(F.col("doc_id"), 5) != 0))
    found = language_id.predict(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all documents at a Jaccard similarity of 0.8 of five-word shingles."""
    prepare(spark)
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents, learned outside the held-out fold."""
    prepare(spark)
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(F.col("doc_id"), 3) != 1))
    return model.score(docs).select(
        "doc_id", (fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prefix trie of all rebuilt conversations with its totals."""
    prepare(spark)
    return prefix_trie.build(read(spark, sf_dir, "conversations"))


def op12_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, weak ones where their complementary parts co-occur."""
    prepare(spark)
    return secret_link.Scan(read(spark, sf_dir, "documents")).report()


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    prepare(spark)
    return permuterm.group(read(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": op1_lm_score,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_rules": op3_quality_rules,
    "op4_histogram_sort": op4_histogram_sort,
    "op5_warc_archive": op5_warc_archive,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_quality_classifier": op7_quality_classifier,
    "op8_language_id": op8_language_id,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_toxicity": op10_toxicity,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_secret_scans": op12_secret_scans,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op5_warc_archive": warc.ORACLE,
    "op6_benchmark_decontamination": decontaminate.ORACLE,
    "op11_prefix_trie": prefix_trie.ORACLE,
    "op12_secret_scans": secret_link.ORACLE,
    "op13_spelling_variants": permuterm.ORACLE,
}
