"""LM scoring: cross-entropy difference of a target and a background bigram model.

The target corpus is the documents marked good, the background all documents.
Both models share one vocabulary and one form,

    P(w | v) = (c(v w) + MU * P1(w)) / (c(v) + MU),

with exact counts of their own corpus. P1(w) = (c(w) + 1/2) / (tokens + types / 2)
is a unigram model with the exact counts of all words. A document is scored
without its own occurrences: they are taken off the counts of its bigrams and of
their contexts (not off the counts of frequent contexts, where they hardly matter,
and not off P1). A text's score is its mean loss per token under the target model
minus that under the background model; lower means more like the target.

Counts grow with the corpus, so they are neither capped nor broadcast: every
bigram occurrence goes once to the bucket of its second word, with the number of
its document within the slice it came from. That bucket holds all occurrences of
the word, so it counts c(w), c(v w), and, where the word is not the last of its
text, its count as a context. A loss is log(c(w) + MU) for the word as a context
minus log(c(v w) + MU * P1(w)), and both are priced where they are counted; the
sums per document come back. Only what is frequent beyond 1 in :data:`FREQUENT`
tokens of all documents (at most that many words and bigrams, counted exactly) is
known everywhere: frequent contexts and bigrams are priced in the slice, and other
bigrams of a frequent word are dealt out by both words, so no bucket fills with
one of them. Of bigrams a slice reports those that reach a part of the frequent
share there; what the slices leave out is bounded by their tokens, so no frequent
one is missed. Bigrams that fill less than 1 in :data:`BUCKET_PART` of a bucket
are left to the buckets, which give them the same loss.

Defined cases: null, empty and blank texts have no token, losses and score 0;
without target documents the target model has no counts and is near uniform; repeated rows are scored and counted each;
labels repeated for a document count once (the smallest); a null doc_id is scored
as background; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded, frames, materialize, one_label, text_words

MU = 20.0
FREQUENT = 50_000
#: A slice reports a bigram from this part (1 in so many) of the frequent share on.
SEARCH_PART = 2
#: Documents of a slice, and bigram occurrences of a bucket.
SLICE = 2_000
BUCKET = 2_000_000
#: A bigram is worth knowing everywhere from this part (1 in so many) of a bucket on.
BUCKET_PART = 256
#: Parts in which a bucket is worked off, and room for the documents of a slice.
PARTS = 8
WIDTH = 1 << 13
#: Bits beside a document's number: it is good, the word ends its text, the word is frequent.
GOOD, LAST, OFTEN = np.uint16(1 << 15), np.uint16(1 << 14), np.uint16(1 << 13)
#: Largest number of target ids that is broadcast; above, documents are shuffled to them.
BROADCAST_IDS = 1_000_000

U = np.uint64
START = U(0x5EED)
LOW = U(0xFFFFFFFF)
WORD, PAIR, TYPES = 1, 2, 3
COUNTS = ("n", "target", "context", "context_target")


def tokens(texts: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(previous word, word, document) of every token; words as 64-bit hashes, texts start with START."""
    prev, own, doc = [], [], []
    for i, text in enumerate(texts):
        words = text_words(text)
        if words:
            h = pd.util.hash_array(np.array([w.lower() for w in words], dtype=object), categorize=False)
            own.append(h)
            prev.append(np.concatenate([[START], h[:-1]]))
            doc.append(np.full(len(h), i, dtype=np.int64))
    if not own:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(prev), np.concatenate(own), np.concatenate(doc)


def pair(prev: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Bigram keys: 32 bits of each word. A word that is not frequent is further told apart by its bucket."""
    return ((prev & LOW) << U(32)) | (own & LOW)


def ends(doc: np.ndarray) -> np.ndarray:
    """Whether each token is the last of its document."""
    return np.append(doc[1:] != doc[:-1], np.ones(min(1, len(doc)), dtype=bool))


def _find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of a slice (all, target; as words, as contexts): all words, bigrams that may be frequent, all tokens (kind 0)."""
    for batch in frames(batches, SLICE):
        prev, own, doc = tokens(batch["text"])
        good, inner = batch["target"].to_numpy(dtype=bool)[doc], ~ends(doc)
        total = [len(own), int(good.sum()), int((~inner).sum()), int((~inner & good).sum())]
        rows = [pd.DataFrame([[0, 0, *total]], columns=["kind", "key", *COUNTS])]
        names, back, n = np.unique(own, return_inverse=True, return_counts=True)
        part = [np.bincount(back[mask], minlength=len(names)) for mask in (good, inner, inner & good)]
        rows.append(pd.DataFrame({"kind": WORD, "key": names.view(np.int64), **dict(zip(COUNTS, (n, *part), strict=True))}))
        names, n = np.unique(pair(prev, own), return_counts=True)
        may = n * SEARCH_PART * FREQUENT >= len(own)
        rows.append(pd.DataFrame({"kind": PAIR, "key": names[may].view(np.int64), "n": n[may], "target": 0, "context": 0, "context_target": 0}))
        yield pd.concat(rows)


def _count(pairs: np.ndarray):
    """Exact counts (all, target) of the given bigrams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = np.zeros((2, len(pairs)), np.int64)
        for batch in frames(batches, SLICE):
            prev, own, doc = tokens(batch["text"])
            at, known = locate(pairs, pair(prev, own))
            for k, mask in enumerate((known, known & batch["target"].to_numpy(dtype=bool)[doc])):
                found[k] += np.bincount(at[mask], minlength=len(pairs))
        yield pd.DataFrame({"key": pairs.view(np.int64), "n": found[0], "target": found[1]})

    return run


def locate(names: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of each key in sorted names (0 if absent), and whether it is there."""
    if not len(names):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(names, keys), len(names) - 1)
    return at, names[at] == keys


class Known:
    """What every task knows: frequent words and bigrams with exact counts, totals, vocabulary size.

    ``rows``: kind, key and COUNTS of words, of frequent bigrams, of all tokens (kind 0, whose
    context counts are those of START) and of types; words of a small vocabulary may all be there.
    """

    def __init__(self, rows: pd.DataFrame) -> None:
        total = rows[rows["kind"] == 0][list(COUNTS)].sum().to_numpy(dtype=float)
        self.total, self.start_n, self.types = total[:2], total[2:], max(1, rows[rows["kind"] == TYPES]["n"].sum())
        words, pairs = rows[rows["kind"] == WORD], rows[rows["kind"] == PAIR]
        name = words["key"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(name)
        counts = words[list(COUNTS)].to_numpy(dtype=float)[order].T
        often = counts[0] * FREQUENT >= self.total[0]
        self.words, self.word_n, self.context_n = name[order][often], counts[:2, often], counts[2:, often]
        # frequent words come last, so that they are found where low bits are alike
        low = np.lexsort((often, name[order] & LOW))
        self.low, self.low_n = (name[order] & LOW)[low], counts[:2, low]
        name = pairs["key"].to_numpy(dtype=np.int64).view(np.uint64)
        order = np.argsort(name)
        self.pairs, self.pair_n = name[order], pairs[["n", "target"]].to_numpy(dtype=float)[order].T

    def share(self, n: np.ndarray) -> np.ndarray:
        """P1 of words with (all, target) counts ``n``."""
        return (n + 0.5) / (self.total + 0.5 * self.types)[:, None]

    def unigram(self, low: np.ndarray) -> np.ndarray:
        """P1 of known words by their low bits, (background, target) rows; others count as unseen."""
        n = np.zeros((2, len(low)))
        if len(self.low):
            at = np.maximum(np.searchsorted(self.low, low, side="right") - 1, 0)
            n = np.where(self.low[at] == low, self.low_n[:, at], 0.0)
        return self.share(n)


def _deal(known: Known, buckets: int):
    """Bigram occurrences of each slice by bucket; losses of frequent contexts and bigrams are summed at once."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, k = TaskContext.get().partitionId(), 0
        for batch in frames(batches, SLICE):
            prev, own, doc = tokens(batch["text"])
            keys, size = pair(prev, own), len(batch)
            is_good = batch["target"].to_numpy(dtype=bool)
            at, head = locate(known.words, prev)
            context = np.repeat(known.start_n[:, None], len(prev), axis=1)
            context[:, head] = known.context_n[:, at[head]]
            head |= prev == START
            sums = np.stack([np.bincount(doc[head], weights=row, minlength=size) for row in np.log(context[:, head] + MU)])
            at, often = locate(known.pairs, keys)
            where, frequent = locate(known.words, own)
            often &= frequent
            there = at[often]
            if len(there):
                own_doc, first, own_n = np.unique(there * size + doc[often], return_index=True, return_counts=True)
                there, d = own_doc // size, own_doc % size
                off = np.stack([own_n, own_n * is_good[d]])
                p1 = known.share(known.word_n[:, where[often][first]])
                loss = -np.log(known.pair_n[:, there] - off + MU * p1)
                sums += np.stack([np.bincount(d, weights=row * own_n, minlength=size) for row in loss])
            ids = batch["doc_id"].astype("Int64")
            docs = np.stack([
                ids.fillna(0).to_numpy(dtype=np.int64), ids.isna().to_numpy(dtype=np.int64), np.bincount(doc, minlength=size),
                sums[0].view(np.int64), sums[1].view(np.int64),
            ])
            name = (task << 24) + k
            k += 1
            yield pd.DataFrame({"bucket": [name % buckets], "slice": [name], "docs": [docs.tobytes()], "payload": [None]})
            number = doc.astype(np.uint16) | is_good[doc] * GOOD | ends(doc) * LAST | frequent * OFTEN
            own, keys, frequent, number = own[~often], keys[~often], frequent[~often], number[~often]
            # bits that are not in the key tell words apart
            by = np.where(frequent, (keys * U(0x9E3779B97F4A7C15)) >> U(33), own >> U(33))
            bucket = (by % U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, keys, number = bucket[order], keys[order], number[order]
            cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-2))
            if len(keys):
                yield pd.DataFrame({
                    "bucket": bucket[cuts[:-1]], "slice": name, "docs": None,
                    "payload": [keys[a:b].tobytes() + number[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                })

    return run


def _own(item: np.ndarray, doc: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each (item, document) once: item, document, a position of it, occurrences."""
    each, first, own = np.unique(item.astype(np.int64) * docs + doc, return_index=True, return_counts=True)
    return each // docs, each % docs, first, own


def _part(known: Known, keys: np.ndarray, number: np.ndarray, payload: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents (payload * WIDTH + number) and their losses over all occurrences of some words."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros((2, 0))
    good, last, often = (number & bit > 0 for bit in (GOOD, LAST, OFTEN))
    count = lambda at, size, *masks: np.stack([np.bincount(at[m], minlength=size) for m in masks]).astype(float)
    every = np.ones(len(keys), dtype=bool)
    names, first, back = np.unique(keys, return_index=True, return_inverse=True)
    seen, frequent = count(back, len(names), every, good), often[first]
    # a word that is not frequent has all its occurrences here
    _, word = np.unique((names & LOW) << U(1) | frequent, return_inverse=True)
    p1 = known.share(np.stack([np.bincount(word, weights=row)[word] for row in seen]))
    p1[:, frequent] = known.unigram((names & LOW)[frequent])
    # each document's own occurrences of a bigram and of a context are taken off
    doc = payload.astype(np.int64) * WIDTH + (number & np.uint16(WIDTH - 1))
    docs, doc = np.unique(doc, return_inverse=True)
    item, d, at, own = _own(back, doc, len(docs))
    loss = -np.log(seen[:, item] - own * np.stack([every[at], good[at]]) + MU * p1[:, item]) * own
    sums = np.stack([np.bincount(d, weights=row, minlength=len(docs)) for row in loss])
    head = ~often & ~last
    if head.any():
        word, good, doc = word[back[head]], good[head], doc[head]
        context = count(word, int(word.max()) + 1, every[head], good)
        item, d, at, own = _own(word, doc, len(docs))
        loss = np.log(context[:, item] - own * np.stack([every[at], good[at]]) + MU) * own
        sums += np.stack([np.bincount(d, weights=row, minlength=len(docs)) for row in loss])
    return docs, sums


def _losses(known: Known):
    """Per slice: sums of losses by document over the bucket's occurrences."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        lists = rows[rows["docs"].notna()][["slice", "docs"]]
        rows = rows[rows["payload"].notna()]
        out = [pd.DataFrame({"slice": lists["slice"], "docs": lists["docs"], "sums": None})]
        if len(rows):
            sizes = [len(p) // 10 for p in rows["payload"]]
            keys = np.concatenate([np.frombuffer(p, np.uint64, n) for p, n in zip(rows["payload"], sizes, strict=True)])
            number = np.concatenate([np.frombuffer(p, np.uint16, n, 8 * n) for p, n in zip(rows["payload"], sizes, strict=True)])
            payload = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
            # words, and bigrams of frequent ones, are independent, so a bucket is worked off in parts of them
            part = (np.where(number & OFTEN > 0, keys, keys & LOW) * U(0x9E3779B97F4A7C15) >> U(40)) % U(PARTS)
            done = [_part(known, keys[m], number[m], payload[m]) for m in (part == U(k) for k in range(PARTS))]
            doc, loss = np.concatenate([d for d, _ in done]), np.concatenate([x for _, x in done], axis=1)
            doc, at = np.unique(doc, return_inverse=True)
            loss = np.stack([np.bincount(at, weights=row, minlength=len(doc)) for row in loss]).astype(np.float32)
            cuts = np.searchsorted(doc // WIDTH, np.arange(len(sizes) + 1))
            sums = [
                (doc[start:end] % WIDTH).astype(np.uint16).tobytes() + loss[:, start:end].tobytes()
                for start, end in zip(cuts[:-1], cuts[1:], strict=True)
            ]
            out.append(pd.DataFrame({"slice": rows["slice"], "docs": None, "sums": sums}))
        return pd.concat(out)

    return run


def _gather(rows: pd.DataFrame) -> pd.DataFrame:
    """Scores of the documents of a slice."""
    docs = np.frombuffer(rows["docs"].dropna().iloc[0], dtype=np.int64).reshape(5, -1)
    n, total = docs[2], docs[3:].copy().view(np.float64)
    for p in sorted(rows["sums"].dropna()):
        k = len(p) // 10
        total[:, np.frombuffer(p, np.uint16, k)] += np.frombuffer(p, np.float32, 2 * k, 2 * k).reshape(2, k)
    mean = np.round(total / np.maximum(n, 1), 6)
    return pd.DataFrame({
        "doc_id": pd.Series(docs[0], dtype="Int64").mask(docs[1] > 0), "n_tokens": n, "target_loss": mean[1],
        "background_loss": mean[0], "score": np.round(mean[1] - mean[0], 6),
    })


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """Score all ``docs`` (doc_id, text) against the documents whose ids are in ``target``."""
    ids = target.select("doc_id").where("doc_id IS NOT NULL").distinct().withColumn("target", F.lit(True))
    marked = docs.select("doc_id", "text").join(bounded(ids, BROADCAST_IDS), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(False)).alias("target"))

    long = ", ".join(f"{c} long" for c in COUNTS)
    found = marked.mapInPandas(_find, f"kind int, key long, {long}").groupBy("kind", "key").agg(*[F.sum(c).alias(c) for c in COUNTS])
    found = materialize(found, "counts")
    words, pairs = found.where(F.col("kind") == WORD), found.where(F.col("kind") == PAIR)
    types = words.count()
    total = found.where("kind = 0").agg(F.sum("n")).first()[0] or 0
    # at most FREQUENT words; a bigram of `least` occurrences has lost fewer than total / (SEARCH_PART * FREQUENT) of them
    least = max(total / FREQUENT, BUCKET / BUCKET_PART)
    names = pairs.where(F.col("n") >= least - total / (SEARCH_PART * FREQUENT)).select("key").toPandas()
    names = np.sort(names["key"].to_numpy(dtype=np.int64).view(np.uint64))
    often = words.where(F.col("n") * FREQUENT >= total)
    rows = [often.union(found.where("kind = 0")).toPandas(), pd.DataFrame([[TYPES, 0, types, 0, 0, 0]], columns=found.columns)]
    if len(names):
        counted = marked.mapInPandas(_count(names), "key long, n long, target long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))
        rows.append(counted.where(F.col("n") >= least).toPandas().assign(kind=PAIR, context=0, context_target=0))
    known = Known(pd.concat(rows))

    buckets = max(16, int(known.total[0]) // BUCKET)
    dealt = marked.mapInPandas(_deal(known, buckets), "bucket long, slice long, docs binary, payload binary")
    sums = dealt.groupBy("bucket").applyInPandas(_losses(known), "slice long, docs binary, sums binary")
    return sums.groupBy("slice").applyInPandas(
        _gather, "doc_id long, n_tokens long, target_loss double, background_loss double, score double"
    )


def good_documents(labels: DataFrame) -> DataFrame:
    """Ids of documents whose quality label is 1."""
    return one_label(labels, "quality").where("label = 1").select("doc_id")
