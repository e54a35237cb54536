"""Mixing sources to target weights.

Each source's documents, in a pseudorandom but fixed order, form one stream of
words that is packed into blocks of :data:`BLOCK_WORDS` words (the last block of
a source may be shorter). A weight per source and a total give target sizes; a
target stops at :data:`MOST_REPEATS` times its source, and the excess is shared
by weight among the others. The mix is a list of slots in output shards of
:data:`SHARD_SLOTS` slots: every shard draws its source counts from a multinomial
over the sources' remaining quotas, so shards are mixed alike and the totals meet
the targets to within a block. The k-th slot of a source is mapped through a
pseudorandom permutation of the source's block indices (a Feistel network, walked
until it falls into range); after all blocks are taken once the permutation
starts again. Slots join blocks by index.

Everything is a function of the seed, so reruns agree. Word counts and offsets
are prefix sums within hash buckets of a source plus the totals of the buckets
before, so a hot source is spread over many tasks. The driver holds one number
per source, and per source and group of :data:`SHARD_GROUP` shards; the shards of a
group are drawn in a task.

Defined cases: null or empty texts have size 0 and are never taken; a null source
is a source of its own, ordered last; sources of size 0 have target 0; repeated
rows count and are taken each (they are one document of the stream each); an
empty table gives an empty mix; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType

from .common import materialize, packed, text_words

BLOCK_WORDS = 64
SHARD_SLOTS = 65_536
#: Output shards whose draws the driver makes as one, and slots that a task makes.
SHARD_GROUP, SLOTS_PER_TASK = 64, 1 << 16
MOST_REPEATS = 2
#: Documents of a hash bucket in a source's stream.
BUCKET_ROWS = 2_000
#: Weights given to the sources in order, again and again, and the share of all words to take.
WEIGHTS, SHARE = (5, 2, 1), 1.5
SEED = 20_231
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pandas_udf(LongType())
def count_words(text: pd.Series) -> pd.Series:
    return pd.Series([len(text_words(t)) for t in text], dtype="int64")


def targets(sizes: Sequence[int], weights: Sequence[float], total: float) -> list[float]:
    """Share ``total`` by weight; nobody gets more than twice its size, the excess is shared again."""
    out, open_, left = [0.0] * len(sizes), [i for i, n in enumerate(sizes) if n > 0], float(total)
    while open_:
        unit = left / sum(weights[i] for i in open_)
        full = [i for i in open_ if unit * weights[i] > MOST_REPEATS * sizes[i]]
        if not full:
            for i in open_:
                out[i] = unit * weights[i]
            break
        for i in full:
            out[i] = float(MOST_REPEATS * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(full)]
    return out


def shard_counts(quota: np.ndarray, shard_slots: int, seed: int = SEED) -> np.ndarray:
    """Slots of each source in each shard, (shards, sources); columns sum to ``quota``.

    Each shard is a multinomial draw with the remaining quotas as weights; what a
    draw takes beyond a quota goes to the sources with most left.
    """
    rng, left, rows = np.random.default_rng(seed), quota.astype(np.int64).copy(), []
    while left.sum():
        n = min(shard_slots, int(left.sum()))
        drawn = np.minimum(rng.multinomial(n, left / left.sum()), left)
        while (short := n - int(drawn.sum())) > 0:
            k = int(np.argmax(left - drawn))
            drawn[k] += min(short, int(left[k] - drawn[k]))
        left -= drawn
        rows.append(drawn)
    return np.array(rows, dtype=np.int64) if rows else np.zeros((0, len(quota)), np.int64)


def _draw_shards(shard_slots: int, seed: int):
    """Slots of each source in the shards of a group, from the group's own numbers: (shard, src, n, first slot of the source)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for group, quota, start in zip(b["shard_group"], b["n"], b["first"], strict=True):
                counts = shard_counts(np.asarray(quota, np.int64), shard_slots, seed + 1 + int(group))
                first = np.asarray(start, np.int64) + np.vstack([np.zeros((1, counts.shape[1]), np.int64), counts.cumsum(0)])[:-1]
                shard, src = np.nonzero(counts)
                yield pd.DataFrame({"shard": int(group) * SHARD_GROUP + shard, "src": src, "n": counts[shard, src], "first": first[shard, src]})

    return run


def permute(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Pseudorandom permutation of range(size), for each element its own size and key."""
    bits = np.maximum(2, np.ceil(np.log2(np.maximum(size, 2))).astype(np.int64))
    half = ((bits + 1) // 2).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, h, m, k = out[todo], half[todo], mask[todo], key[todo].astype(np.uint64)
        left, right = x >> h, x & m
        for turn in range(4):
            f = (right + k + np.uint64(turn * 0x51ED27)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(31)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= size[todo].astype(np.uint64)]
    return out.astype(np.int64)


@pandas_udf(LongType())
def permuted(index: pd.Series, size: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series(permute(index.to_numpy(), size.to_numpy(), key.to_numpy()))


class Mix:
    """The mix of ``docs``: ``placed`` documents, ``slots`` of the output shards, ``taken`` words.

    ``placed`` has doc_id, text_key, row (a number of repeated rows), size, src (index of
    the source), start (offset in the source's stream); ``sources`` is the driver's table.
    """

    def __init__(
        self, docs: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
        block: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED,
    ) -> None:
        spark = docs.sparkSession
        self.block, self.seed = block, seed
        sized = docs.select(
            "doc_id", "source", F.xxhash64("text").alias("text_key"), count_words("text").alias("size")
        )
        sized = materialize(sized, "mix-sizes")
        rows = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        self.sources = rows.orderBy(F.col("source").asc_nulls_last()).toPandas()
        names, sizes = self.sources["source"].tolist(), [int(x) for x in self.sources["size"]]
        self.sources["target"] = targets(sizes, [weights[i % len(weights)] for i in range(len(sizes))], share * sum(sizes))
        self.sources["blocks"] = [-(-n // block) for n in sizes]
        # slots by the source's mean block, so that a short last block doesn't count as a whole one
        quota = np.array([round(t * b / n) if n else 0 for t, b, n in zip(*(self.sources[c] for c in ("target", "blocks", "size")), strict=True)], dtype=np.int64)

        table = [
            (i, None if pd.isna(s) else s, n, float(t), int(b), int(np.uint64(seed * 1_000_003 + i) & np.uint64(0x7FFFFFFF)))
            for i, (s, n, t, b) in enumerate(zip(names, sizes, self.sources["target"], self.sources["blocks"], strict=True))
        ]
        self.table = spark.createDataFrame(table, "src int, name string, source_size long, target double, blocks long, key long")
        buckets = max(1, int(self.sources["n"].sum()) // BUCKET_ROWS) if len(self.sources) else 1
        sized = sized.join(F.broadcast(self.table.select("src", "name")), F.col("source").eqNullSafe(F.col("name"))).drop("name")
        sized = sized.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "text_key", F.lit(seed)), F.lit(buckets)))
        # repeated rows: one row of the group with its number of copies
        sized = sized.groupBy("src", "source", "bucket", "doc_id", "text_key").agg(
            F.max("size").alias("size"), F.count("*").alias("copies")
        )
        words = F.col("size") * F.col("copies")
        within = Window.partitionBy("src", "bucket").orderBy(F.xxhash64("doc_id", F.lit(seed + 1)), "doc_id", "text_key")
        sized = sized.withColumn("inner", F.sum(words).over(within.rowsBetween(Window.unboundedPreceding, 0)) - words)
        sized = materialize(sized, "mix-inner")
        totals = sized.groupBy("src", "bucket").agg(F.sum(words).alias("words"))
        before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        totals = totals.select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"))
        self.placed = sized.join(totals, ["src", "bucket"]).select(
            "doc_id", "text_key", "source", "src", "size", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"),
            (F.col("before") + F.col("inner")).alias("first"),
        ).withColumn("start", F.col("first") + F.col("copy") * F.col("size")).drop("first")

        # the driver draws for groups of shards; a group's shards are drawn where its slots are made
        draws = shard_counts(quota, shard_slots * SHARD_GROUP, seed)
        first = np.vstack([np.zeros((1, draws.shape[1]), np.int64), draws.cumsum(0)])[:-1] if len(draws) else draws
        groups = spark.createDataFrame(
            [(g, draws[g].tolist(), first[g].tolist()) for g in range(len(draws))], "shard_group long, n array<long>, first array<long>"
        )
        shards = groups.repartition(max(1, len(draws)), "shard_group").mapInPandas(_draw_shards(shard_slots, seed), "shard long, src int, n long, first long")
        # many tasks whatever the size of the draws: an explicit number is not merged by AQE
        tasks = max(1, int(quota.sum()) // SLOTS_PER_TASK)
        at = F.explode(F.sequence("first", F.col("first") + F.col("n") - 1))
        slots = shards.repartition(tasks, "shard", "src").select("shard", "src", at.alias("k"))
        slots = slots.join(F.broadcast(self.table.select("src", "blocks", "key")), "src")
        turn = F.floor(F.col("k") / F.col("blocks"))
        self.slots = slots.select(
            "shard", "src", turn.alias("turn"),
            permuted(F.col("k") % F.col("blocks"), "blocks", "key").alias("block"),
        )

    def pieces(self) -> DataFrame:
        """Where documents lie in blocks: a row per document and block, words [begin, end) of the document."""
        n, start = F.lit(self.block), F.col("start")
        cut = self.placed.where("size > 0").withColumn(
            "block", F.explode(F.sequence(F.floor(start / n), F.floor((start + F.col("size") - 1) / n)))
        )
        begin = F.greatest(F.col("block") * n - start, F.lit(0).cast("long"))
        end = F.least((F.col("block") + 1) * n - start, F.col("size"))
        return cut.select("doc_id", "text_key", "copy", "src", "block", begin.alias("begin"), end.alias("end"))

    def mixed(self) -> DataFrame:
        """The mix itself: a row per slot and piece of its block (shard, turn, doc_id, words [begin, end))."""
        return self.slots.join(self.pieces(), ["src", "block"])

    def taken(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target of its source, words taken."""
        times = self.slots.groupBy("src", "block").agg(F.count("*").alias("times"))
        words = (
            self.pieces().join(times, ["src", "block"])
            .groupBy("doc_id", "text_key", "copy", "src").agg(F.sum((F.col("end") - F.col("begin")) * F.col("times")).alias("taken"))
        )
        same = ["doc_id", "text_key", "copy", "src"]
        left, right = self.placed.alias("l"), words.alias("r")
        on = F.lit(True)
        for c in same:
            on = on & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
        return (
            left.join(right, on, "left").select("l.*", "r.taken")
            .join(F.broadcast(self.table.select("src", "source_size", "target")), "src")
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"), "source", "text_key")
        )


def cut_words(text: Column, spans: Column) -> Column:
    """The words of the merged spans [begin, end) of a text, with the text's own spacing inside a span."""

    @pandas_udf("string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, own in zip(texts, spans, strict=True):
            at, parts = None, []
            merged: list[list[int]] = []
            for s in sorted((int(s["begin"]), int(s["end"])) for s in own):
                if merged and s[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], s[1])
                else:
                    merged.append(list(s))
            at = [m.span() for m in WORD.finditer(text)]
            if merged == [[0, len(at)]]:
                parts = [text]
            else:
                parts = [text[at[a][0] : at[b - 1][1]] for a, b in merged]
            out.append("\n".join(parts))
        return pd.Series(out, dtype=object)

    return cut(text, spans)


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The mixed corpus as documents: for each turn, the words of a document that the mix takes in it.

    A document that the mix takes twice gives two rows; one whose blocks are not
    taken gives none; a partly taken one keeps the words of the taken blocks.
    ``n_chars`` counts the remaining text; other columns stay as they are. Texts
    without a word can't be packed and leave the corpus here.
    """
    mix = Mix(docs)
    spans = (
        mix.mixed().groupBy("doc_id", "text_key", "src", "copy", "turn")
        .agg(F.collect_set(F.struct("begin", "end")).alias("spans"))
        .join(F.broadcast(mix.table.select("src", "name")), "src")
        .select("doc_id", "text_key", F.col("name").alias("source_name"), "spans", "copy")
    )
    spans = materialize(spans, "mix-spans")
    keyed = packed(docs).withColumn("source", F.col("row.source"))
    # rows repeated exactly were numbered by the mix; one of them carries all copies
    if not spans.where("copy > 0").isEmpty():
        keyed = keyed.dropDuplicates(["id", "key", "source"])
    same = keyed["id"].eqNullSafe(spans["doc_id"]) & (keyed["key"] == spans["text_key"])
    rows = keyed.join(spans, same & keyed["source"].eqNullSafe(spans["source_name"]))
    rows = rows.select("row", cut_words(F.col("row.text"), F.col("spans")).alias("text"))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return rows.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
