"""Language ID: expectation-maximisation of language proportions, penalised selection.

Character n-grams (one to three letters, words padded by blanks) are hashed to
:data:`GRAMS` ids. Per language, their counts over all training documents are
summed within partitions and then over all partitions, and smoothed. A document
is a mixture of languages: its gram counts c and the proportions p give the log
likelihood sum c log(sum p_l P(g | l)), maximised over p by EM. The set of
languages is grown greedily, and a language joins only where the likelihood gains
more than the penalty :data:`PENALTY` log(n) (n: grams in the text). The
prediction is the language of the largest proportion, its score that proportion
weighted by how clearly the set beats the best single other language.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
languages of training rows are taken as they are, null ones not used; without any
training row every text is ``und``; repeated rows get the same result; equal
proportions go to the language first in code point order.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GRAMS = 1 << 15
#: Counts are exchanged in pieces of this many grams.
PIECE = 1 << 12
SMOOTHING = 0.5
PENALTY = 8.0
STEPS = 30
UNDETERMINED = "und"
LETTER = re.compile(r"[^\W\d_]")
NOT_LETTERS = re.compile(r"[\W\d_]+")


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Ids and counts of the n-grams of a text; empty without a letter."""
    if not text or not LETTER.search(text):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    clean = f"  {NOT_LETTERS.sub(' ', text.lower()).strip()} "
    c = np.frombuffer(clean.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    space = c == 32
    two, three = c[1:-1] * np.uint64(1 << 21) + c[2:], c[:-2] * np.uint64(1 << 42) + c[1:-1] * np.uint64(1 << 21) + c[2:]
    all_ = np.concatenate([c[2:][~space[2:]], two[~(space[1:-1] & space[2:])], three[~(space[1:-1])]])
    all_ = (all_ ^ (all_ >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    ids = ((all_ ^ (all_ >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - 15)
    counts = np.bincount(ids.astype(np.int64), minlength=GRAMS)
    found = np.flatnonzero(counts)
    return found, counts[found]


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for text, lang in zip(batch["text"], batch["lang"], strict=True):
            ids, counts = grams(text)
            if len(ids):
                total.setdefault(lang, np.zeros(GRAMS, dtype=np.int64))[ids] += counts
    for lang, counts in total.items():
        pieces = counts.reshape(-1, PIECE)
        yield pd.DataFrame({"lang": lang, "piece": np.arange(len(pieces)), "counts": list(pieces)})


def _add(rows: pd.DataFrame) -> pd.DataFrame:
    counts = np.sum(np.stack(rows["counts"].to_numpy()), axis=0)
    return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "piece": [rows["piece"].iloc[0]], "counts": [counts]})


class Model:
    """Learned languages (in code point order) and their gram probabilities (languages, GRAMS)."""

    def __init__(self, langs: list[str], counts: np.ndarray) -> None:
        self.langs = langs
        smooth = counts + SMOOTHING
        self.prob = smooth / smooth.sum(axis=1, keepdims=True) if len(langs) else smooth

    def proportions(self, ids: np.ndarray, counts: np.ndarray, chosen: list[int]) -> tuple[np.ndarray, float]:
        """EM over the chosen languages: proportions and log likelihood."""
        p = self.prob[np.ix_(chosen, ids)]
        if len(chosen) == 1:
            return np.ones(1), float(counts @ np.log(p[0]))
        share, n = np.full(len(chosen), 1 / len(chosen)), counts.sum()
        for _ in range(STEPS):
            mixed = share @ p
            new = share * (p @ (counts / mixed)) / n
            if np.abs(new - share).max() < 1e-4:
                share = new
                break
            share = new
        return share, float(counts @ np.log(share @ p))

    def predict(self, text: str | None) -> tuple[str, float, dict[str, float]]:
        """Language, score and the proportions of the selected languages."""
        ids, counts = grams(text)
        if not len(ids) or not self.langs:
            return UNDETERMINED, 0.0, {}
        n, penalty = counts.sum(), PENALTY * np.log(1.0 + counts.sum())
        alone = np.log(self.prob[:, ids]) @ counts
        chosen, best = [int(np.argmax(alone))], float(alone.max())
        share = np.ones(1)
        rest = [i for i in np.argsort(-alone, kind="stable").tolist() if i != chosen[0]]
        while rest:
            # only languages with grams that the chosen ones explain badly can gain enough
            mixed = share @ self.prob[np.ix_(chosen, ids)]
            bound = [float(counts @ np.maximum(0.0, np.log(self.prob[i, ids] / mixed))) for i in rest]
            tries = [(self.proportions(ids, counts, [*chosen, i]), i) for i, b in zip(rest, bound, strict=True) if b > penalty]
            if not tries:
                break
            (new, like), i = max(tries, key=lambda t: t[0][1])
            if like - best <= penalty:
                break
            chosen, share, best = [*chosen, i], new, like
            rest.remove(i)
        top = max(range(len(chosen)), key=lambda k: (share[k], -chosen[k]))
        others = np.delete(alone, chosen[top])
        margin = (alone[chosen[top]] - others.max()) / n if len(others) else 1.0
        sure = 1 / (1 + np.exp(-np.clip(4 * margin * min(n, 100), -30, 30)))
        return self.langs[chosen[top]], float(share[top] * sure), {self.langs[c]: float(s) for c, s in zip(chosen, share, strict=True)}


def fit(docs: DataFrame) -> Model:
    """Learn from all rows given (text, lang)."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("text", "lang")
    schema = "lang string, piece long, counts array<long>"
    rows = known.mapInPandas(_count, schema).groupBy("lang", "piece").applyInPandas(_add, schema).toPandas()
    langs = sorted(rows["lang"].unique().tolist())
    counts = np.zeros((len(langs), GRAMS))
    at = {lang: i for i, lang in enumerate(langs)}
    for lang, piece, c in rows.itertuples(index=False):
        counts[at[lang], piece * PIECE : (piece + 1) * PIECE] = c
    return Model(langs, counts)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, languages): languages are the selected ones with their proportions."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [model.predict(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "lang_pred": [o[0] for o in out], "score": [o[1] for o in out],
                "languages": [o[2] for o in out],
            })

    return docs.select("doc_id", "text").mapInPandas(run, "doc_id long, lang_pred string, score double, languages map<string,double>")
