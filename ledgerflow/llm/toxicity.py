"""Toxicity: a weighted lexicon matched by Aho-Corasick after folding disguises.

Texts are folded first: compatibility forms, accents, look-alike letters of other
scripts and digits or signs used as letters become plain Latin letters (l, i, 1
and their like are one letter), everything else separates words. A digit or sign next to
letters may also be itself, so such a word has two readings: a plain one, in which
only substitutes between or before letters are undone, and a full one, in which all
are. The lexicon is learned from plain readings; both are matched. The lexicon is
learned from labelled documents: terms are whole words and word beginnings
(:data:`STEMS` letters), counted by the distinct words of a document that they
match, with partial sums over all labelled rows of a class; terms mostly found in
toxic documents stay, weighted by their log odds. Phrases of a term and a neighbouring word that occur mostly in
harmless documents become exceptions, which cancel the hits inside them.

Terms and exceptions are tables. Up to :data:`LEXICON_PART` of each, tasks get them
whole; a larger table is cut by hash into parts of about that many, and one part's
automaton after another goes over the texts; a word's heaviest term, and whether
an exception covers it, are then taken over all parts. The result is the same, and
neither the driver nor a task ever holds more than a part.

A text's hits are the words matched by some term (the heaviest one counts) outside
exceptions. Their weights, per thousand words and as a bounded sum, go through a
logistic curve fitted on at most :data:`FIT_ROWS` labelled rows.

Defined cases: null, empty and wordless texts have no hit and get the score of no
hit; without labels of both kinds every score is 0; repeated rows get the same
score; labels repeated for a document count once (the smallest); labels of absent
documents and null labels are not used; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from .common import bounded, materialize, one_label

#: Lengths of word beginnings that can be terms.
STEMS = (4, 5, 6, 7, 8)
#: A term needs so many toxic documents, such a share of toxic documents' words among
#: its words (both classes weighted alike) and such a log-likelihood ratio against chance.
MIN_DOCS, MIN_PRECISION, MIN_RATIO = 3, 0.9, 30.0
#: An exception phrase needs so many harmless documents and such a share of them.
MIN_HARMLESS, EXCEPTION_SHARE = 3, 0.9
FIT_ROWS = 20_000
#: Most labels that are broadcast (about 16 bytes each); above, documents are shuffled to them.
BROADCAST_LABELS = 1_000_000
MAX_WEIGHT = 6.0
#: Terms (or exceptions) that the driver collects and a task holds at a time, some 200 bytes each.
LEXICON_PART = 250_000
#: Terms that a task counts before it passes the counts on.
HELD = 400_000

#: Look-alikes of Latin letters in other scripts, and signs used as letters (fixed values).
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t",
    "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ɡ": "g", "α": "a",
    "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ł": "l", "ø": "o", "đ": "d", "ß": "ss",
}
LEET = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i", "|": "i"}
SAME_LETTER = {"l": "i"}

WORDS = re.compile(r"[^\W_]+")
#: In the plain reading a digit or sign stands for a letter only with a letter on both
#: sides, or in a word that begins with it and goes on with letters.
SIGN = re.compile(r"[0134578@$!|]")
DISGUISED = re.compile(r"(?<=[^\W\d_])[0134578@$!|]+(?=[^\W\d_])|(?<![\w@$!|])[0134578@$]+(?=[^\W\d_]{2})")

#: In the full reading all of them do, in any run of them that holds a letter.
MORE_LEET = {"2": "z", "6": "g", "9": "g", "+": "t"}
RUN = re.compile(r"(?<![^\W_])(?<![@$!|+])(?:[^\W\d_]*+[0-9@$!|+])(?:[^\W_]|[@$!|+])*+")
#: Signs that may end a word as punctuation.
ENDS = "!|+"


def _plain_letters() -> dict[int, str]:
    """Accented Latin letters to their base letter, by decomposition."""
    table = {}
    for code in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFKD", chr(code))[0]
        if base != chr(code) and base.isascii():
            table[code] = base.lower()
    return table


FOLD = {**{chr(k): v for k, v in _plain_letters().items()}, **HOMOGLYPHS}
FOLDED = frozenset(FOLD)
SIGNS = {ord(k): v for k, v in LEET.items()}
ALL_SIGNS = {ord(k): v for k, v in (LEET | MORE_LEET | SAME_LETTER).items()}

#: A full reading: it stands for the words from the first position up to the second.
Reading = tuple[int, int, str]


def fold(text: str | None) -> list[str]:
    """Words of a text after folding (plain readings)."""
    return readings(text)[0]


def readings(text: str | None) -> tuple[list[str], list[Reading]]:
    """Words of a text after folding, and the full readings that differ from them."""
    if not text:
        return [], []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    if not text.isascii():
        for letter in FOLDED.intersection(text):
            text = text.replace(letter, FOLD[letter])
    raw = text
    if SIGN.search(text):
        text = DISGUISED.sub(lambda m: m[0].translate(SIGNS), text)
    for letter, same in SAME_LETTER.items():
        text = text.replace(letter, same)
    # letter for letter, so places in raw and in text are the same
    starts, full = None, []
    for m in RUN.finditer(raw):
        run = m[0]
        if run.isdecimal() or not any(map(str.isalpha, run)):
            continue
        plain = text[m.start() : m.end()]
        for form in {run, run.rstrip(ENDS)}:
            form = form.translate(ALL_SIGNS)
            if form != plain[: len(form)] or plain[len(form) : len(form) + 1].isalnum():
                if starts is None:
                    starts = [w.start() for w in WORDS.finditer(text)]
                full.append((bisect_left(starts, m.start()), bisect_left(starts, m.end()), form))
    return WORDS.findall(text), sorted(full)


def terms_of(words: set[str]) -> Counter:
    """Terms of a document, " word " for whole words and " begin" for beginnings, with the words of each."""
    out = Counter(f" {w} " for w in words)
    for n in STEMS:
        out.update(f" {w[:n]}" for w in words if len(w) > n)
    return out


def _totals(seen: tuple[Counter, Counter]) -> pd.DataFrame:
    terms = list(seen[1].keys() | seen[0].keys())
    packed = [np.array([c[t] for t in terms], dtype=np.int64) for c in seen]
    return pd.DataFrame({
        "term": terms, "toxic": packed[1] >> 32, "other": packed[0] >> 32, "docs": packed[1] & 0xFFFFFFFF,
    })


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """By term: distinct words of toxic and of other documents, and toxic documents.

    Partial counts of at most about HELD terms; a counter holds words << 32 | documents.
    """
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, label in zip(batch["text"], batch["label"], strict=True):
            total = seen[1 if label else 0]
            for term, n in terms_of(set(fold(text))).items():
                total[term] += (n << 32) + 1
            if len(seen[0]) + len(seen[1]) > HELD:
                yield _totals(seen)
                seen = (Counter(), Counter())
    if seen[0] or seen[1]:  # an empty column of strings has no Arrow form here
        yield _totals(seen)


def choose_terms(rows: list[tuple[str, int, int]], n_toxic: int, n_other: int) -> dict[str, float]:
    """Weights of (term, words in toxic, words in other documents); a beginning that a longer term stands for is left out."""
    rows = sorted(rows)
    weights = {}
    for i, (term, toxic, other) in enumerate(rows):
        if not term.endswith(" "):
            j, covered = i + 1, False
            while j < len(rows) and rows[j][0].startswith(term) and not covered:
                covered = rows[j][1] >= 0.95 * toxic
                j += 1
            if covered:
                continue
        odds = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
        weights[term] = float(min(MAX_WEIGHT, max(0.0, odds)))
    return weights


def uncovered(good: DataFrame) -> DataFrame:
    """The terms (term, toxic, other) without the beginnings that a longer one of them stands for."""
    begins = F.array(*[F.when(F.length("term") > n + 1, F.substring("term", 1, n + 1)) for n in STEMS])
    longer = good.select(F.explode(begins).alias("term"), "toxic").where(F.col("term").isNotNull())
    longer = longer.groupBy("term").agg(F.max("toxic").alias("longest"))
    covered = ~F.col("term").endswith(" ") & (F.coalesce("longest", F.lit(0)) >= 0.95 * F.col("toxic"))
    return good.join(longer, "term", "left").where(~covered).select("term", "toxic", "other")


class Matcher:
    """Aho-Corasick automata of terms and exception phrases over folded texts."""

    def __init__(self, terms: dict[str, float], exceptions: set[str]) -> None:
        self.terms, self.exceptions = ahocorasick.Automaton(), ahocorasick.Automaton()
        for term, weight in terms.items():
            self.terms.add_word(term, (len(term) - 1, weight))
        for phrase in exceptions:
            self.exceptions.add_word(phrase, len(phrase) - 1)
        for a in (self.terms, self.exceptions):
            if len(a):
                a.make_automaton()

    def hits(self, words: list[str]) -> dict[int, float]:
        """Start of each matched word in the joined text, with its heaviest term's weight."""
        if not len(self.terms) or not words:
            return {}
        joined, found = f" {' '.join(words)} ", {}
        for end, (back, weight) in self.terms.iter(joined):
            found[end - back] = max(weight, found.get(end - back, 0.0))
        if found and len(self.exceptions):
            for end, back in self.exceptions.iter(joined):
                for at in [a for a in found if end - back <= a < end]:
                    del found[at]
        return found

    def excepted(self, words: list[str], at: int) -> bool:
        """Whether an exception phrase covers the word that starts at ``at`` in the joined text."""
        if not len(self.exceptions):
            return False
        return any(end - back <= at < end for end, back in self.exceptions.iter(f" {' '.join(words)} "))


def full_hits(words: list[str], full: list[Reading], hits: dict[int, float], matcher: Matcher) -> dict[tuple[int, int], tuple[float, str]]:
    """Of words without a plain hit, the matched full reading with the heaviest term: (first, end) to weight and reading."""
    found: dict[tuple[int, int], tuple[float, str]] = {}
    places = None
    for first, end, form in full:
        before = words[first - 1 : first] if first else []
        weight = matcher.hits([*before, form, *words[end : end + 1]]).get(sum(len(w) + 1 for w in before))
        if weight is None:
            continue
        if places is None:
            places = [0, *accumulate(len(w) + 1 for w in words)]
        if not any(places[k] in hits for k in range(first, end)):
            found[first, end] = max(found.get((first, end), (0.0, "")), (weight, form))
    return found


def phrases_of(words: list[str], matcher: Matcher, full: list[Reading] = ()) -> set[str]:
    """Phrases of a matched word and the word before or after it."""
    hits, at, out = matcher.hits(words), 0, set()
    for k, w in enumerate(words):
        if at in hits:
            if k:
                out.add(f" {words[k - 1]} {w} ")
            if k + 1 < len(words):
                out.add(f" {w} {words[k + 1]} ")
        at += len(w) + 1
    for (first, end), (_, form) in full_hits(words, full, hits, matcher).items():
        out.update(f" {w} {form} " for w in words[max(0, first - 1) : first])
        out.update(f" {form} {w} " for w in words[end : end + 1])
    return out


def evidence(words: list[str], matcher: Matcher, full: list[Reading] = ()) -> tuple[int, float, float]:
    """Hits, their weight per thousand words (log scale), and their bounded sum."""
    hits = matcher.hits(words)
    more = full_hits(words, full, hits, matcher)
    total = sum(hits.values()) + sum(weight for weight, _ in more.values())
    return len(hits) + len(more), float(np.log1p(1000.0 * total / max(20, len(words)))), min(1.0, total / (3 * MAX_WEIGHT))


def parts_of(table: DataFrame, n: int) -> Iterator[list]:
    """Rows of ``table`` (with a column term, n rows) in parts of about LEXICON_PART, by hash."""
    k = max(1, -(-n // LEXICON_PART))
    for p in range(k):
        yield table.where(F.pmod(F.xxhash64("term"), F.lit(k)) == p).collect()


#: A matched word of a text: words first up to end, "" or the full reading that matched, heaviest weight.
HIT = "uid long, first int, end int, form string, weight double"
SPOT = ["uid", "first", "end", "form"]


def _matched(words: list[str], full: list[Reading], matcher: Matcher) -> list[tuple[int, int, str, float]]:
    """All hits of one automaton in a text: plain words and full readings, each with its heaviest term."""
    out, places = [], {}
    hits = matcher.hits(words)
    if hits:
        places = {at: k for k, at in enumerate(accumulate((len(w) + 1 for w in words[:-1]), initial=0))}
        out = [(places[at], places[at] + 1, "", weight) for at, weight in hits.items()]
    for first, end, form in full:
        before = words[first - 1 : first] if first else []
        weight = matcher.hits([*before, form, *words[end : end + 1]]).get(sum(len(w) + 1 for w in before))
        if weight is not None:
            out.append((first, end, form, weight))
    return out


def match_parts(texts: DataFrame, terms: DataFrame, n: int) -> DataFrame:
    """Hits of ``texts`` (uid, text) over all parts of ``terms`` (term, weight), before exceptions."""
    found = None
    for rows in parts_of(terms, n):
        own = {r["term"]: r["weight"] for r in rows}

        def run(batches: Iterator[pd.DataFrame], own=own) -> Iterator[pd.DataFrame]:
            matcher = Matcher(own, set())
            for batch in batches:
                out = [(uid, *hit) for uid, text in zip(batch["uid"], batch["text"], strict=True) for hit in _matched(*readings(text), matcher)]
                if out:
                    yield pd.DataFrame(out, columns=[*SPOT, "weight"])

        part = materialize(texts.select("uid", "text").mapInPandas(run, HIT), "toxic-hits")  # the part's rows can go
        found = part if found is None else found.unionByName(part)
    return found.groupBy(*SPOT).agg(F.max("weight").alias("weight"))


def _with_hits(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Texts that have hits, with these as an array."""
    own = hits.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("first", "end", "form", "weight"))).alias("hits"))
    return texts.join(own, "uid")


def _resolved(hits: list) -> dict[tuple[int, int], tuple[float, str]]:
    """Hits that count: plain words, and of readings without one the heaviest (of equal weight the last in order)."""
    plain = {h["first"]: (h["weight"], "") for h in hits if not h["form"]}
    out = {(k, k + 1): v for k, v in plain.items()}
    more: dict[tuple[int, int], tuple[float, str]] = {}
    for h in hits:
        spot = h["first"], h["end"]
        if h["form"] and not any(k in plain for k in range(*spot)):
            more[spot] = max(more.get(spot, (0.0, "")), (h["weight"], h["form"]))
    return out | more


def cancel_parts(texts: DataFrame, hits: DataFrame, exceptions: DataFrame, n: int) -> DataFrame:
    """``hits`` without those that an exception phrase (term) covers, over all parts of ``exceptions``."""
    held = materialize(_with_hits(texts.select("uid", "text"), hits), "toxic-held")
    gone = None
    for rows in parts_of(exceptions, n):
        own = {r["term"] for r in rows}

        def run(batches: Iterator[pd.DataFrame], own=own) -> Iterator[pd.DataFrame]:
            matcher = Matcher({}, own)
            for batch in batches:
                out = []
                for uid, text, hits in zip(batch["uid"], batch["text"], batch["hits"], strict=True):
                    words = fold(text)
                    for h in hits:
                        spot = [h["form"]] if h["form"] else words[h["first"] : h["end"]]
                        before = words[h["first"] - 1 : h["first"]] if h["first"] else []
                        if matcher.excepted([*before, *spot, *words[h["end"] : h["end"] + 1]], sum(len(w) + 1 for w in before)):
                            out.append((uid, h["first"], h["end"], h["form"]))
                if out:
                    yield pd.DataFrame(out, columns=SPOT)

        part = materialize(held.mapInPandas(run, "uid long, first int, end int, form string"), "toxic-cancelled")
        gone = part if gone is None else gone.unionByName(part)
    return hits.join(gone.distinct(), SPOT, "left_anti")


def phrase_counts(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """Phrases of a hit and a neighbouring word: term, and toxic and other texts that hold it."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label, hits in zip(batch["text"], batch["label"], batch["hits"], strict=True):
                words, found = fold(text), set()
                for (first, end), (_, form) in _resolved(hits).items():
                    spot = form or words[first]
                    found.update(f" {w} {spot} " for w in words[max(0, first - 1) : first])
                    found.update(f" {spot} {w} " for w in words[end : end + 1])
                seen[1 if label else 0].update(found)
            names = list(seen[0].keys() | seen[1].keys())
            if names:
                yield pd.DataFrame({"term": names, "toxic": [seen[1][t] for t in names], "other": [seen[0][t] for t in names]})

    return _with_hits(texts, hits).mapInPandas(run, "term string, toxic long, other long")


def evidence_parts(texts: DataFrame, hits: DataFrame) -> DataFrame:
    """(uid, n_hits, a, b) of texts (uid, n_words) with hits: what :func:`evidence` gives."""

    @pandas_udf(StructType([StructField("n", IntegerType()), StructField("total", DoubleType())]))
    def summed(hits: pd.Series) -> pd.DataFrame:
        found = [_resolved(h) for h in hits]
        return pd.DataFrame({"n": [len(f) for f in found], "total": [float(sum(w for w, _ in f.values())) for f in found]})

    own = _with_hits(texts, hits).select("uid", "n_words", summed("hits").alias("s"))
    share = F.log1p(F.lit(1000.0) * F.col("s.total") / F.greatest(F.lit(20), F.col("n_words")))
    return own.select("uid", F.col("s.n").alias("n_hits"), share.alias("a"), F.least(F.lit(1.0), F.col("s.total") / (3 * MAX_WEIGHT)).alias("b"))


def _counted_words(texts: DataFrame) -> DataFrame:
    """``texts`` kept on shared storage with a number (uid) and their folded words' count."""

    @pandas_udf(LongType())
    def n_words(text: pd.Series) -> pd.Series:
        return pd.Series([len(fold(t)) for t in text], dtype="int64")

    return materialize(texts.select("*", F.monotonically_increasing_id().alias("uid"), n_words("text").alias("n_words")), "toxic-texts")


class Model:
    """Fitted lexicon, exceptions and logistic curve; tables beyond LEXICON_PART rows stay tables."""

    def __init__(
        self, terms: dict[str, float], exceptions: set[str], curve: np.ndarray | None, tables: tuple[DataFrame, int, DataFrame, int] | None = None
    ) -> None:
        self.terms, self.exceptions, self.curve, self.tables = terms, exceptions, curve, tables

    def score(self, docs: DataFrame) -> DataFrame:
        """(doc_id, n_words, n_hits, score) of every row."""
        terms, exceptions, curve = self.terms, self.exceptions, self.curve
        if self.tables is not None:
            return self._score_by_parts(docs)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            matcher = Matcher(terms, exceptions)
            for batch in batches:
                rows = []
                for text in batch["text"]:
                    words, full = readings(text)
                    rows.append((len(words), *evidence(words, matcher, full)))
                x = np.array(rows, dtype=float).reshape(-1, 4)
                z = np.zeros(len(x)) if curve is None else 1 / (1 + np.exp(-(curve[0] + x[:, 2:] @ curve[1:])))
                yield pd.DataFrame({"doc_id": batch["doc_id"], "n_words": x[:, 0].astype(int), "n_hits": x[:, 1].astype(int), "score": z})

        return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, n_words long, n_hits long, score double")

    def _score_by_parts(self, docs: DataFrame) -> DataFrame:
        terms, n_terms, exceptions, n_exceptions = self.tables
        texts = _counted_words(docs.select("doc_id", "text"))
        hits = cancel_parts(texts, match_parts(texts, terms, n_terms), exceptions, n_exceptions)
        own = evidence_parts(texts.select("uid", "n_words"), hits)
        rows = texts.select("uid", "doc_id", "n_words").join(own, "uid", "left")
        c = [0.0, 0.0, 0.0] if self.curve is None else [float(x) for x in self.curve]
        z = F.lit(c[0]) + F.coalesce("a", F.lit(0.0)) * c[1] + F.coalesce("b", F.lit(0.0)) * c[2]
        score = F.lit(0.0) if self.curve is None else 1 / (1 + F.exp(-z))
        return rows.select("doc_id", "n_words", F.coalesce("n_hits", F.lit(0)).cast("long").alias("n_hits"), score.alias("score"))


def fit_curve(x: np.ndarray, y: np.ndarray) -> np.ndarray | None:
    """Penalised logistic regression of labels on the evidence (Newton steps)."""
    if len(set(y.tolist())) < 2:
        return None
    x = np.column_stack([np.ones(len(x)), x])
    w, penalty = np.zeros(x.shape[1]), np.diag([1e-3, 0.1, 0.1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty @ w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty, grad)
    return w


def _exceptions(counts: DataFrame, n_toxic: int, n_other: int) -> DataFrame:
    """Phrases (term) that occur in enough harmless texts and mostly there."""
    toxic, other = F.col("toxic") / n_toxic, F.col("other") / n_other
    return counts.where((F.col("other") >= MIN_HARMLESS) & (other >= EXCEPTION_SHARE * (toxic + other))).select("term")


def _fit_by_parts(known: DataFrame, lexicon: DataFrame, n_terms: int, n_toxic: int, n_other: int) -> Model:
    """The same model with terms and exceptions kept as tables; ``known`` has doc_id, text, label."""
    odds = F.log((F.col("toxic") + 0.5) / (n_toxic + 1)) - F.log((F.col("other") + 0.5) / (n_other + 1))
    weight = F.least(F.lit(MAX_WEIGHT), F.greatest(F.lit(0.0), odds))
    terms = materialize(lexicon.select("term", weight.alias("weight")), "lexicon")
    texts = _counted_words(known)
    hits = materialize(match_parts(texts, terms, n_terms), "toxic-hits")
    counts = phrase_counts(texts, hits).groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
    exceptions = materialize(_exceptions(counts, n_toxic, n_other), "exceptions")
    n_exceptions = exceptions.count()
    own = evidence_parts(texts.select("uid", "n_words"), cancel_parts(texts, hits, exceptions, n_exceptions))
    xy = texts.select("uid", "doc_id", "label").join(own, "uid", "left")
    xy = xy.select("doc_id", F.coalesce("a", F.lit(0.0)).alias("a"), F.coalesce("b", F.lit(0.0)).alias("b"), "label")
    return Model({}, set(), _curve(xy), (terms, n_terms, exceptions, n_exceptions))


def _curve(xy: DataFrame) -> np.ndarray | None:
    """The logistic curve, fitted on at most FIT_ROWS measured rows (doc_id, a, b, label)."""
    xy = xy.orderBy(F.xxhash64("doc_id"), "doc_id", "a").limit(FIT_ROWS).toPandas()
    return fit_curve(xy[["a", "b"]].to_numpy(), (xy["label"] > 0).to_numpy().astype(float))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from the labelled documents given (doc_id, text; doc_id, toxic)."""
    marked = bounded(one_label(labels, "toxic"), BROADCAST_LABELS)
    known = docs.select("doc_id", "text").join(marked, "doc_id").select("doc_id", "text", "label")
    sizes = {int(r["label"] > 0): r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        return Model({}, set(), None)
    pairs = known.select("text", "label")
    counts = pairs.mapInPandas(_count, "term string, toxic long, other long, docs long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other"), F.sum("docs").alias("docs")
    )
    toxic, other, share = F.col("toxic"), F.col("other"), n_toxic / (n_toxic + n_other)
    ratio = 2 * (
        toxic * F.log(toxic / ((toxic + other) * share))
        + F.when(other > 0, other * F.log(other / ((toxic + other) * (1 - share)))).otherwise(0.0)
    )
    precise = toxic / n_toxic >= MIN_PRECISION * (toxic / n_toxic + other / n_other)
    good = counts.where(F.col("docs") >= MIN_DOCS).where(precise & (ratio >= MIN_RATIO))
    lexicon = materialize(uncovered(materialize(good.select("term", "toxic", "other"), "terms")), "lexicon")
    n_terms = lexicon.count()
    if n_terms > LEXICON_PART:
        return _fit_by_parts(known, lexicon, n_terms, n_toxic, n_other)
    terms = choose_terms([(r["term"], r["toxic"], r["other"]) for r in lexicon.collect()], n_toxic, n_other)

    def phrases(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms, set())
        for batch in batches:
            seen: tuple[Counter, Counter] = (Counter(), Counter())
            for text, label in zip(batch["text"], batch["label"], strict=True):
                words, full = readings(text)
                seen[1 if label else 0].update(phrases_of(words, matcher, full))
            names = list(seen[0].keys() | seen[1].keys())
            if names:
                yield pd.DataFrame({"term": names, "toxic": [seen[1][t] for t in names], "other": [seen[0][t] for t in names]})

    found = pairs.mapInPandas(phrases, "term string, toxic long, other long").groupBy("term").agg(
        F.sum("toxic").alias("toxic"), F.sum("other").alias("other")
    )
    found = materialize(_exceptions(found, n_toxic, n_other), "exceptions")
    n_exceptions = found.count()
    if n_exceptions > LEXICON_PART:
        return _fit_by_parts(known, lexicon, n_terms, n_toxic, n_other)
    exceptions = {r["term"] for r in found.collect()}

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = Matcher(terms, exceptions)
        for batch in batches:
            found = [evidence(words, matcher, full) for words, full in map(readings, batch["text"])]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "a": [e[1] for e in found], "b": [e[2] for e in found], "label": batch["label"]})

    # all labelled texts are measured where they lie; the sample is taken of the small rows
    return Model(terms, exceptions, _curve(known.mapInPandas(measure, "doc_id long, a double, b double, label int")))
