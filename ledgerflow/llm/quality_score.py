"""Quality classifier: random Fourier features, ridge regression, isotonic calibration.

A text becomes a vector of :data:`STATISTICS` (lengths, shares of character
classes, repetition, ...), computed once per document and kept as a table. On the
standardised vectors, random Fourier features approximate a Gaussian kernel. The
normal equations of the ridge regression are summed within partitions and then
row by row of the matrix over all partitions, so nothing but one feature-by-feature
matrix reaches the driver; all labelled rows take part. Scores are calibrated
by isotonic regression (pool adjacent violators) on a part of the labelled rows
that the regression has not seen, counted in :data:`BINS` bins of the raw score.

Defined cases: null, empty and blank texts have zero statistics and a score like
any other; without labels of both kinds every score is the share of good labels
(0.5 without any); repeated rows get the same score; a document's repeated labels
count once (the smallest); null labels are not used; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, one_label, text_words

FEATURES = 256
BANDWIDTH = 3.0
RIDGE = 1e-3
BINS = 1000
SEED = 7
#: Of ten parts of the labelled rows (by hash) these calibrate.
CALIBRATION_PARTS = 3

STATISTICS = (
    "log_chars", "log_words", "log_lines", "word_chars", "letters", "upper", "digits", "spaces",
    "symbols", "exclamations", "pipes", "full_stops", "other_marks", "upper_words", "symbol_words",
    "distinct_words", "repeat_next", "top_word", "distinct_pairs", "distinct_lines", "short_lines",
    "entropy", "non_ascii",
)


def statistics(text: str | None) -> list[float]:
    """:data:`STATISTICS` of a whole text; all 0 for a text without a word."""
    words = text_words(text)
    if not words:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    chars = len(raw) - int(counts[0x80:0xC0].sum())
    n = len(words)
    lower, upper, digits = int(counts[97:123].sum()), int(counts[65:91].sum()), int(counts[48:58].sum())
    beyond = int(counts[0xC0:].sum())
    symbols = int(counts[[ord(c) for c in "#*$%&<>{}=+^~\\/@_"]].sum())
    lines = [s for s in text.split("\n") if s.strip()]
    codes = pd.factorize(np.array(words, dtype=object))[0]
    seen = np.bincount(codes)
    pairs = codes[:-1].astype(np.int64) * len(seen) + codes[1:]
    share = counts[counts > 0] / len(raw)
    return [
        np.log1p(chars), np.log1p(n), np.log1p(len(lines)), sum(map(len, words)) / n / 10,
        (lower + upper + beyond) / chars, upper / chars, digits / chars, int(counts[32]) / chars,
        symbols / n, int(counts[33]) / n, int(counts[124]) / n, int(counts[46]) / n,
        int(counts[[ord(c) for c in ",;:?\"'()-"]].sum()) / n,
        sum(w.isupper() for w in words) / n, sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / n,
        len(seen) / n, float((codes[1:] == codes[:-1]).mean()) if n > 1 else 0.0, int(seen.max()) / n,
        len(np.unique(pairs)) / len(pairs) if len(pairs) else 1.0, len(set(lines)) / len(lines),
        sum(len(s) < 30 for s in lines) / len(lines), float(-(share * np.log2(share)).sum()) / 8, beyond / chars,
    ]


def _statistics(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"doc_id": batch["doc_id"], "x": [statistics(t) for t in batch["text"]]})


def describe(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the statistics of every row, as a stored table."""
    found = docs.select("doc_id", "text").mapInPandas(_statistics, "doc_id long, x array<double>")
    return materialize(found, "statistics")


class Fourier:
    """Random cosine features of standardised statistics, and a constant."""

    def __init__(self, mean: np.ndarray, std: np.ndarray, size: int = FEATURES, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        self.mean, self.std = mean, np.where(std > 1e-9, std, 1.0)
        self.freq = rng.normal(0, 1 / BANDWIDTH, (len(mean), size))
        self.phase = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.std, -5, 5)
        return np.column_stack([np.sqrt(2 / len(self.phase)) * np.cos(z @ self.freq + self.phase), np.ones(len(x))])


def normal_equations(rows: DataFrame, features: Fourier) -> tuple[np.ndarray, np.ndarray]:
    """Sums of f f' and f y over (x, label) rows: per partition, then per matrix row."""
    size = len(features.phase) + 1

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, any_ = np.zeros((size, size + 1)), False
        for b in batches:
            if len(b):
                f = features(np.stack(b["x"].to_numpy()))
                total += f.T @ np.column_stack([f, b["label"].to_numpy(dtype=float)])
                any_ = True
        if any_:
            yield pd.DataFrame({"i": np.arange(size), "row": list(total)})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"i": [rows["i"].iloc[0]], "row": [np.sum(np.stack(rows["row"].to_numpy()), axis=0)]})

    parts = rows.select("x", "label").mapInPandas(partial, "i long, row array<double>")
    summed = parts.groupBy("i").applyInPandas(add, "i long, row array<double>").toPandas()
    out = np.zeros((size, size + 1))
    for i, row in zip(summed["i"], summed["row"], strict=True):
        out[i] = row
    return out[:, :size], out[:, size]


def isotonic(x: np.ndarray, good: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Non-decreasing least-squares fit of good / n at sorted x (pool adjacent violators)."""
    blocks: list[list[float]] = []  # sum, weight, points
    for g, w in zip(good, n, strict=True):
        blocks.append([float(g), float(w), 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            g2, w2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + g2, blocks[-1][1] + w2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), g / w) for g, w, k in blocks]) if blocks else np.zeros(0)


class Model:
    """Fitted weights and calibration curve; ``constant`` is used where nothing could be fitted."""

    def __init__(self, features: Fourier | None, weights: np.ndarray | None, curve: tuple[np.ndarray, np.ndarray], constant: float) -> None:
        self.features, self.weights, self.curve, self.constant = features, weights, curve, constant

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip(self.features(x) @ self.weights, 0, 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        if self.features is None:
            return np.full(len(x), self.constant)
        raw = self.raw(x)
        at, level = self.curve
        return np.clip(np.interp(raw, at, level), 0, 1) if len(at) else raw

    def score(self, stats: DataFrame) -> DataFrame:
        """(doc_id, score) of a table of statistics."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = np.stack(b["x"].to_numpy()) if len(b) else np.zeros((0, len(STATISTICS)))
                yield pd.DataFrame({"doc_id": b["doc_id"], "score": self(x)})

        return stats.select("doc_id", "x").mapInPandas(run, "doc_id long, score double")


def fit(stats: DataFrame, labels: DataFrame) -> Model:
    """Fit on the statistics of all labelled documents given (doc_id, x; doc_id, quality)."""
    known = materialize(stats.join(one_label(labels, "quality"), "doc_id").select("doc_id", "x", "label"), "labelled")
    each = [F.struct(F.avg(F.get("x", F.lit(i))).alias("m"), F.stddev_pop(F.get("x", F.lit(i))).alias("s")).alias(str(i)) for i in range(len(STATISTICS))]
    first = known.agg(F.count("*").alias("n"), F.avg("label").alias("good"), F.min("label").alias("low"), F.max("label").alias("high"), *each).first()
    if not first["n"] or first["low"] == first["high"]:
        return Model(None, None, (np.zeros(0), np.zeros(0)), 0.5 if not first["n"] else float(first["good"]))
    mean, std = (np.array([first[str(i)][k] for i in range(len(STATISTICS))]) for k in ("m", "s"))
    features = Fourier(mean, std)
    part = F.pmod(F.xxhash64("doc_id", F.lit("calibration")), F.lit(10))
    a, b = normal_equations(known.where(part >= CALIBRATION_PARTS), features)
    n = max(1.0, a[-1, -1])
    weights = np.linalg.solve(a + RIDGE * n * np.eye(len(a)) * np.r_[np.ones(len(a) - 1), 1e-9], b)
    model = Model(features, weights, (np.zeros(0), np.zeros(0)), float(first["good"]))

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                raw = model.raw(np.stack(batch["x"].to_numpy()))
                yield pd.DataFrame({"bin": np.minimum((raw * BINS).astype(int), BINS - 1), "raw": raw, "label": batch["label"]})

    held = known.where(part < CALIBRATION_PARTS).select("x", "label").mapInPandas(bins, "bin long, raw double, label long")
    held = held.groupBy("bin").agg(F.avg("raw").alias("raw"), F.sum("label").alias("good"), F.count("*").alias("n")).orderBy("bin").toPandas()
    if len(held):
        level = isotonic(held["raw"].to_numpy(), held["good"].to_numpy(), held["n"].to_numpy())
        model.curve = (held["raw"].to_numpy(), level)
    return model
