"""Quality rules: lines labelled content or boilerplate by a linear-chain CRF.

Every text is cut at ``\\n`` into lines. A conditional random field with two
states (content, boilerplate) scores each line by its features and each step by
a transition weight; Viterbi decoding gives the best state sequence of the whole
text, and the share of words in content lines decides retention. Fixed base
rules (too few words, too many repeated three-word windows) reject first.

The field is fitted on a bounded sample of documents with a quality label
(:data:`SAMPLE_DOCS`, at most :data:`SAMPLE_LINES` lines each). Labels are per
document, so the emission weights are fitted first, lines of rejected documents
that look like content are relabelled, and then the full field is fitted by
gradient ascent on the conditional likelihood (forward-backward). Without any
label the fixed prior weights are used.

Defined cases: null or empty text has no words and fails the base rules; lines
without a word have no label and join their neighbours; repeated rows each get
the same verdict; an empty table gives an empty result; other columns pass
through :func:`keep_content` untouched.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import one_label, text_words

#: Bound of the fitting sample: documents, and lines of a sampled document.
SAMPLE_DOCS = 3000
SAMPLE_LINES = 64
#: Base rules and the share of words in content lines that a kept text needs.
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MIN_CONTENT_SHARE = 0.5

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
FEATURES = (
    "bias", "symbols", "symbol_words", "capitals", "exclamations", "repeats", "seen_before",
    "digits", "very_short", "markup", "unpunctuated", "few_letters",
)
#: Weights for boilerplate against content, used where no document is labelled:
#: a line needs two strong signs.
PRIOR = np.array([-3.0, 3.0, 3.0, 2.0, 2.0, 3.0, 2.0, 1.0, 0.5, 2.0, 0.2, 2.0])
PRIOR_TRANSITION = np.array([[1.0, -1.0], [-1.0, 1.0]])

VERDICT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, n_lines long, n_content_lines long, content_share double, kept boolean"
)


def line_features(line: str, words: list[bytes], seen: bool) -> list[float]:
    """Feature vector of one line with at least one word, each value in [0, 1]."""
    n, chars = len(words), max(1, len(line))
    symbols = sum(line.count(c) for c in SYMBOLS)
    bang = line.count("!")
    letters = sum(map(str.isalpha, line))
    upper = line.isupper()
    again = sum(map(bytes.__eq__, words, words[1:]))
    return [
        1.0,
        min(1.0, 4.0 * symbols / n),
        1.0 if 2 * symbols >= n else 0.0,
        1.0 if upper and n > 1 else 0.0,
        min(1.0, 2.0 * bang / n),
        min(1.0, 2.0 * again / n),
        float(seen),
        min(1.0, 5.0 * sum(line.count(d) for d in "0123456789") / chars),
        1.0 if n < 4 else 0.0,
        1.0 if "</" in line or "{" in line else 0.0,
        0.0 if line.rstrip(SPACES)[-1:] in ".!?:;\"”»" else 1.0,
        1.0 if 2 * letters < chars else 0.0,
    ]


def lines_of(text: str | None) -> tuple[np.ndarray, np.ndarray, int]:
    """Features and word counts of the lines with a word, and how many of them are repeats."""
    feats, counts, seen, dups = [], [], set(), 0
    for line in (text or "").split("\n"):
        words = text_words(line)
        if words:
            again = line in seen
            dups += again
            seen.add(line)
            feats.append(line_features(line, words, again))
            counts.append(len(words))
    return np.array(feats, dtype=float).reshape(-1, len(FEATURES)), np.array(counts, dtype=np.int64), dups


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which occurs twice or more."""
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    if len(windows) == max(0, len(words) - 2):
        return 0
    hit = np.zeros(len(words), dtype=bool)
    again = np.fromiter(
        (windows[w] > 1 for w in zip(words, words[1:], words[2:], strict=False)), bool, len(words) - 2
    )
    for k in range(3):
        hit[k : len(words) - 2 + k] |= again
    return int(hit.sum())


def viterbi(emission: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """Best state sequence; emission: (lines, 2), transition: (2, 2). Ties go to content (0)."""
    if not len(emission):
        return np.zeros(0, dtype=np.int8)
    (t00, t01), (t10, t11) = transition.tolist()
    a, b = emission[0].tolist()
    back = []
    for e0, e1 in emission[1:].tolist():
        p0, p1 = (0, 0) if a + t00 >= b + t10 else (1, 0), (0, 1) if a + t01 >= b + t11 else (1, 1)
        back.append((p0[0], p1[0]))
        a, b = e0 + max(a + t00, b + t10), e1 + max(a + t01, b + t11)
    path = [0 if a >= b else 1]
    for step in reversed(back):
        path.append(step[path[-1]])
    return np.array(path[::-1], dtype=np.int8)


def fit_crf(docs: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from (line features, label) of sampled documents.

    ``label`` 1 marks a good document. Two gradient ascents on the conditional
    log-likelihood with a quadratic penalty: emissions alone on the document's
    label, then emissions and transitions on the relabelled lines.
    """
    docs = [(x, y) for x, y in docs if len(x)]
    if len({y for _, y in docs}) < 2:
        return PRIOR, PRIOR_TRANSITION
    x = np.concatenate([d for d, _ in docs])
    bad = np.concatenate([np.full(len(d), 1.0 - y) for d, y in docs])
    w = np.zeros(x.shape[1])
    for _ in range(25):  # Newton steps of the penalised logistic regression
        p = 1 / (1 + np.exp(-x @ w))
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(len(w))
        w -= np.linalg.solve(hess, x.T @ (p - bad) + w)
    line_bad = (bad > 0) & (x @ w > 0)

    size, longest = len(docs), max(len(d) for d, _ in docs)
    feats, mask, state = np.zeros((size, longest, x.shape[1])), np.zeros((size, longest)), np.zeros((size, longest), int)
    at = 0
    for i, (d, _) in enumerate(docs):
        feats[i, : len(d)], mask[i, : len(d)], state[i, : len(d)] = d, 1, line_bad[at : at + len(d)]
        at += len(d)
    pair = mask[:, 1:]
    seen_t = np.array([[((state[:, :-1] == i) & (state[:, 1:] == j) & (pair > 0)).sum() for j in (0, 1)] for i in (0, 1)], float)
    seen_w = np.einsum("nlf,nl->f", feats, mask * state)
    trans, n = np.zeros((2, 2)), mask.sum()
    m = [np.zeros_like(w), np.zeros_like(trans)]
    v = [np.zeros_like(w), np.zeros_like(trans)]
    for step in range(1, 121):
        e = np.stack([np.zeros_like(mask), feats @ w], -1)
        alpha, beta = np.zeros_like(e), np.zeros_like(e)
        alpha[:, 0] = e[:, 0]
        for t in range(1, longest):
            nxt = np.logaddexp.reduce(alpha[:, t - 1, :, None] + trans, axis=1) + e[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, nxt, alpha[:, t - 1])
        total = np.logaddexp.reduce(alpha[:, -1], axis=1)
        for t in range(longest - 2, -1, -1):
            nxt = np.logaddexp.reduce(trans + (e[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, nxt, 0)
        p_bad = np.exp(alpha[:, :, 1] + beta[:, :, 1] - total[:, None]) * mask
        joint = alpha[:, :-1, :, None] + trans + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - total[:, None, None, None]
        exp_t = (np.exp(joint) * pair[:, :, None, None]).sum((0, 1))
        grads = [(seen_w - np.einsum("nlf,nl->f", feats, p_bad) - w) / n, (seen_t - exp_t - trans) / n]
        for k, (value, g) in enumerate(zip((w, trans), grads, strict=True)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.99 * v[k] + 0.01 * g * g
            value += 0.1 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return w, trans


def fit(docs: DataFrame, labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Fit the field on the :data:`SAMPLE_DOCS` labelled documents of smallest id hash."""

    @pandas_udf("array<array<double>>")
    def features(text: pd.Series) -> pd.Series:
        return pd.Series([lines_of(t)[0].tolist() for t in text])

    few = F.size(F.split(F.col("text"), "\n", SAMPLE_LINES + 1)) <= SAMPLE_LINES
    chosen = one_label(labels, "quality").orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = (
        docs.select("doc_id", "text")
        .where(F.col("text").isNotNull() & few)
        .join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text"))
        .limit(SAMPLE_DOCS)
        .select(features("text").alias("x"), "label")
    )
    return fit_crf([(np.array([list(r) for r in x], dtype=float).reshape(-1, len(FEATURES)), y) for x, y in sample.collect()])


def verdict(weights: np.ndarray, transition: np.ndarray, text: str | Column = "text") -> Column:
    """Struct column (:data:`VERDICT`) of a text column: base counts, decoded lines, verdict."""

    @pandas_udf(VERDICT)
    def decide(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            text = text or ""
            words = text_words(text)
            x, counts, dups = lines_of(text)
            score = x @ weights
            content = viterbi(np.stack([np.zeros_like(score), score], 1), transition) == 0
            share = float(counts[content].sum() / counts.sum()) if len(words) else 0.0
            again = repeat_words(words)
            failed = len(words) < MIN_WORDS or 100 * again > MAX_REPEAT_PCT * len(words)
            chars = len(text) - sum(text.count(c) for c in SPACES)
            out.append((
                len(words), chars, sum(text.count(c) for c in SYMBOLS), dups, again, failed,
                len(counts), int(content.sum()), share, not failed and share >= MIN_CONTENT_SHARE,
            ))
        return pd.DataFrame(out, columns=[c.split()[0] for c in VERDICT.split(", ")])

    return decide(text)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id and the fields of :data:`VERDICT`."""
    v = verdict(*fit(docs, labels))
    return docs.select("doc_id", v.alias("_verdict")).select("doc_id", "_verdict.*")


def keep_content(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep, with their own columns."""
    v = verdict(*fit(docs, labels))
    return docs.where(v["kept"])
