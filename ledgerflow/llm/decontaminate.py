"""Benchmark decontamination: prefix-filtered set join, DataFrame functions only.

An item's windows are its runs of :data:`WINDOW` consecutive words (an item with
fewer words is one shorter window). A window is contained in a document when its
word sequence occurs there. As a set of shingles (:data:`SHINGLE` words each) a
window must be contained whole, so its necessary prefix in any order is a single
shingle; ordering by rarity over all documents makes it the rarest one. The join:

1. Benchmark shingles are counted over all documents (hash join, partial counts).
2. Each window's rarest shingle (ties: the earliest) is its probe. Documents'
   shingles join the probes on a 64-bit hash; length and positional bounds leave
   only windows that fit at that place; the words themselves are then compared.
3. The verified occurrences give, per document, the union of the hit positions
   and the items.

The document's words stay inside one generated stage (explode, probe, verify),
so no word is shuffled. Probes are broadcast while they are at most
:data:`BROADCAST_KEYS`; above that only positions and shingles are shuffled to
them, and the candidates of a document go back to its text once.

Defined cases: null or empty texts have no words and are clean; items without a
word (or null) have no window; a document is known by doc_id and text, repeated
rows give the same result each; an empty benchmark leaves all documents clean;
item ids are compared as strings, null ids take no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded, materialize, packed

#: Words of a decontamination text after lower-casing A-Z (fixed value of the contract).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
SHINGLE = 3
#: Most probes (or benchmark shingles) that are broadcast, about 100 bytes each.
BROADCAST_KEYS = 200_000
#: A document is contaminated when 20 * hit words >= words.
HIT_FACTOR = 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Array of words of a text (null: empty array)."""
    folded = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    return F.filter(F.split(folded, "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"), lambda w: w != "")


def _shingle_at(words: Column, pos: Column, n: int) -> Column:
    """64-bit hash of the words at pos .. pos + n - 1; null where the text ends before."""
    return F.when(
        pos + n <= F.size(words), F.xxhash64(*[F.get(words, pos + k) for k in range(n)])
    )


def windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: win (hash), win_words, n (its words)."""
    items = benchmark.select(words(F.col("text")).alias("w")).where(F.size("w") > 0)
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))))
    cut = items.select("w", starts.alias("at")).select(F.slice("w", F.col("at") + 1, window).alias("win_words"))
    return cut.distinct().select(F.xxhash64("win_words").alias("win"), "win_words", F.size("win_words").alias("n"))


def window_items(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Which items hold which window: win_words, item (id as string)."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w"))
    items = items.where((F.size("w") > 0) & F.col("item").isNotNull())
    starts = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - window, F.lit(0))))
    return (
        items.select("item", "w", starts.alias("at"))
        .select("item", F.xxhash64(F.slice("w", F.col("at") + 1, window)).alias("win"))
        .distinct()
    )


def _exploded(docs: DataFrame, n: int) -> DataFrame:
    """Each document's shingle hashes with their positions, next to its word array."""
    return (
        docs.select("doc_id", "text_key", "words", F.posexplode("words").alias("pos", "_word"))
        .select("doc_id", "text_key", "words", "pos", _shingle_at(F.col("words"), F.col("pos"), n).alias("key"))
        .where("key IS NOT NULL")
    )


def _beside_texts(docs: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """Occurrences with broadcast probes: each is verified where its text is, no word is shuffled."""
    start = F.col("pos") - F.col("offset")
    return (
        _exploded(docs, k).join(F.broadcast(probes), "key")
        .where((start >= 0) & (start + F.col("n") <= F.size("words")))
        .where(F.slice("words", start + 1, F.col("n")) == F.col("win_words"))
        .select("doc_id", "text_key", start.alias("at"), "n", "win")
    )


def _by_candidates(docs: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """The same with probes of any number: only (document, position, shingle) is shuffled to the probes.

    The positional bounds leave few candidates; those of a document go back to its text
    in one row, the words they name are cut out there, and only these are compared
    with the window's words. Every step is linear in words and candidates.
    """
    n_words, start = F.size("words"), F.col("pos") - F.col("offset")
    places = _exploded(docs, k).select("doc_id", "text_key", "pos", n_words.alias("n_words"), "key")
    met = places.join(probes.select("key", "win", "n", "offset"), "key").where((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    met = met.select("doc_id", "text_key", F.struct(start.alias("at"), "n", "win").alias("place"))
    own = met.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias("places"))
    texts = docs.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), "words")
    back = own.join(texts, own["doc_id"].eqNullSafe(texts["d"]) & (own["text_key"] == texts["t"]))
    cut = back.select("doc_id", "text_key", F.explode("places").alias("place"), "words").select(
        "doc_id", "text_key", "place.*", F.slice("words", F.col("place.at") + 1, F.col("place.n")).alias("found")
    )
    same = probes.select(F.col("win").alias("w"), "win_words")
    return cut.join(same, (F.col("win") == F.col("w")) & (F.col("found") == F.col("win_words"))).select("doc_id", "text_key", "at", "n", "win")


def occurrences(docs: DataFrame, wins: DataFrame) -> DataFrame:
    """Verified occurrences: doc_id, text_key, at (first word), n, win. ``docs`` has a words array.

    Windows of fewer than :data:`SHINGLE` words are probed by shorter shingles.
    """
    found = None
    lengths = [r[0] for r in wins.select(F.least("n", F.lit(SHINGLE)).alias("k")).distinct().orderBy("k").collect()]
    for k in lengths:  # at most SHINGLE lengths
        own = wins.where(F.least("n", F.lit(SHINGLE)) == k)
        places = own.select(
            "win", "win_words", "n", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("offset")
        ).withColumn("key", _shingle_at(F.col("win_words"), F.col("offset"), k))
        keys = materialize(places.select("key").distinct(), "benchmark-shingles")
        seen = _exploded(docs, k).select("key").join(bounded(keys, BROADCAST_KEYS), "key").groupBy("key").agg(F.count("*").alias("seen"))
        ranked = places.join(seen, "key", "left").select(
            "*", F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "offset", "key").alias("rank")
        )
        rarest = ranked.groupBy("win").agg(F.min("rank").alias("rank"), F.first("win_words").alias("win_words"), F.first("n").alias("n"))
        # a window whose rarest shingle is in no document occurs nowhere
        probes = materialize(
            rarest.where("rank.seen > 0").select("win", "win_words", "n", F.col("rank.offset").alias("offset"), F.col("rank.key").alias("key")),
            "probes",
        )
        few = probes.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        hits = _beside_texts(docs, probes, k) if few else _by_candidates(docs, probes, k)
        found = hits if found is None else found.union(hits)
    if found is None:
        found = docs.select("doc_id", "text_key", F.lit(0).alias("at"), F.lit(0).alias("n"), F.lit(0).cast("long").alias("win")).where("false")
    return found


def _covered(spans: Column) -> Column:
    """Number of positions in the union of sorted spans (at, end)."""
    start = F.struct(F.lit(0).cast("long").alias("hit"), F.lit(0).alias("reach"))
    return F.aggregate(
        spans, start,
        lambda acc, s: F.struct(
            (acc["hit"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["reach"], s["at"]))).cast("long").alias("hit"),
            F.greatest(acc["reach"], s["end"]).alias("reach"),
        ),
        lambda acc: acc["hit"],
    )


def measure(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: doc_id, text_key, n_words, n_hit, items (sorted ids), contaminated."""
    worded = docs.select("doc_id", F.xxhash64("text").alias("text_key"), words(F.col("text")).alias("words"))
    found = occurrences(worded, windows(benchmark, window)).distinct()
    found = materialize(found, "occurrences")
    key = [F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("doc_id").isNull().alias("_null"), F.col("text_key").alias("_key")]
    spans = (
        found.select(*key, F.struct("at", (F.col("at") + F.col("n")).alias("end")).alias("span"))
        .groupBy("_id", "_null", "_key").agg(_covered(F.sort_array(F.collect_set("span"))).alias("n_hit"))
    )
    items = (
        found.select(*key, "win").distinct().join(window_items(benchmark, window), "win")
        .groupBy("_id", "_null", "_key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hit = spans.join(items, ["_id", "_null", "_key"], "left")
    # the words are counted again here rather than shuffled
    sized = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.size(words(F.col("text"))).cast("long").alias("n_words"))
    sized = sized.select("*", *key)
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return sized.join(hit, ["_id", "_null", "_key"], "left").select(
        "doc_id", "text_key", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (HIT_FACTOR * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, with their own columns."""
    bad = measure(docs, benchmark).where("contaminated").select("doc_id", "text_key").distinct()
    rows = packed(docs)
    return rows.join(bad, rows["id"].eqNullSafe(bad["doc_id"]) & (rows["key"] == bad["text_key"]), "left_anti").select("row.*")


#: The same by brute force: every window of every document against every window of every item.
ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + least(len(w), 13)], ' ') AS body
  FROM (SELECT item, w, unnest(range(0, greatest(len(w) - 13, 0) + 1)) AS s FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
pos AS (SELECT doc_id, n, w, unnest(range(0, greatest(len(w) - n + 1, 0))) AS s FROM dw, lens),
hits AS (
  SELECT DISTINCT doc_id, s, pos.n AS n, item
  FROM (SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS body FROM pos) pos JOIN win USING (n, body)),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id AS doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""
