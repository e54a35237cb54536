import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from ledgerflow.llm import lm_score as lm
from ledgerflow.llm.common import frames


def one_hash(word):
    return int(pd.util.hash_array(np.array([word], dtype=object), categorize=False)[0])


def brute(rows, target, known):
    """Losses of every text with dictionaries; P1 is taken from the fitted unigram model."""
    words = [[w.lower() for w in (t or "").encode().split()] for _, t in rows]
    good = [i in target for i, _ in rows]
    pairs, heads = [Counter(), Counter()], [Counter(), Counter()]
    for w, g in zip(words, good):
        for k in (0, 1) if g else (0,):
            pairs[k].update(zip([None, *w], w))
            heads[k].update([None, *w][: len(w)])
    frequent = set(known.words.tolist())
    out = []
    for (i, _), w, g in zip(rows, words, good):
        own, own_head = Counter(zip([None, *w], w)), Counter([None, *w][: len(w)])
        loss = [0.0, 0.0]
        for k in (0, 1):
            f = 1 if k == 0 or g else 0
            for v, x in zip([None, *w], w):
                p1 = known.unigram(np.array([one_hash(x) & 0xFFFFFFFF], dtype=np.uint64))[k, 0]
                whole = v is None or one_hash(v) in frequent
                c = heads[k][v] - (0 if whole else f * own_head[v])
                loss[k] -= math.log((pairs[k][v, x] - f * own[v, x] + lm.MU * p1) / (c + lm.MU))
        n = max(1, len(w))
        out.append((i, len(w), loss[1] / n, loss[0] / n))
    return out


@pytest.mark.parametrize("small", [False, True])
def test_scores_equal_brute_force(spark, make_docs, monkeypatch, small):
    if small:
        monkeypatch.setattr(lm, "FREQUENT", 30)
        monkeypatch.setattr(lm, "SEARCH_PART", 1)
        monkeypatch.setattr(lm, "BUCKET", 100)
        monkeypatch.setattr(lm, "SLICE", 7)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice(["the", "of", *(f"W{k}" for k in range(25))]) for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, " \t"), (103, "the the the the"), (104, "long text " * 4000), (None, "no id here"), (1, rows[1][1])]
    target = {i for i in range(60) if i % 3 == 0}
    seen = {}
    make = lm.Known.__init__

    def note(self, table):
        make(self, table)
        seen["known"] = self

    monkeypatch.setattr(lm.Known, "__init__", note)
    ids = spark.createDataFrame([(i,) for i in [*target, 999, None]], "doc_id long")
    got = lm.score(make_docs(rows, extra=True), ids).collect()
    assert (len(seen["known"].pairs) > 0) == small
    model = Exact(rows, target, lm.FREQUENT)
    assert set(seen["known"].words.tolist()) == set(model.words.tolist())
    want = brute(rows, target, model)
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r["doc_id"], r["n_tokens"], r["target_loss"], r["background_loss"], r["score"]) for r in got), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in sorted(want, key=key)]
    for g, w in zip(got, sorted(want, key=key)):
        assert g[2] == pytest.approx(w[2], abs=2e-4) and g[3] == pytest.approx(w[3], abs=2e-4)
        assert g[4] == pytest.approx(g[2] - g[3], abs=1e-5)


def test_target_like_texts_score_lower(spark, make_docs):
    rng = random.Random(8)
    text = lambda words: " ".join(rng.choice(words) for _ in range(60))
    a, b = [f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]
    rows = [(i, text(a if i % 2 else b)) for i in range(200)]
    ids = spark.createDataFrame([(i,) for i in range(1, 100, 2)], "doc_id long")
    got = {r["doc_id"]: r["score"] for r in lm.score(make_docs(rows), ids).collect()}
    assert max(got[i] for i in range(101, 200, 2)) < min(got[i] for i in range(100, 200, 2))


def test_without_target_or_documents(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long")
    got = lm.score(make_docs([(1, "a b c"), (2, None)]), none).collect()
    assert sorted(r["n_tokens"] for r in got) == [0, 3]
    assert lm.score(make_docs([]), none).count() == 0
    assert lm.score(make_docs([(1, None)]), none).collect()[0]["score"] == 0.0


def fitted(monkeypatch):
    """Takes note of the model that a run fits."""
    seen, make = {}, lm.Known.__init__

    def note(self, table):
        make(self, table)
        seen["known"] = self

    monkeypatch.setattr(lm.Known, "__init__", note)
    return seen


@pytest.mark.parametrize("parts", [1, 5])
def test_frequent_items_are_those_of_all_documents(spark, make_docs, monkeypatch, parts):
    for name, value in (("FREQUENT", 100), ("BUCKET", 100), ("SLICE", 7)):
        monkeypatch.setattr(lm, name, value)
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(30))) for i in range(40)]
    for g in range(4):  # groups of copies: in or out of a sample as a whole
        rows += [(1000 + 10 * g + k, f"group{g} copy{g} text{g} " * 3) for k in range(6)]
    rng.shuffle(rows)
    seen = fitted(monkeypatch)
    ids = spark.createDataFrame([(1,)], "doc_id long")
    assert lm.score(make_docs(rows).repartition(parts), ids).count() == len(rows)
    words = [t.split() for _, t in rows]
    total = sum(map(len, words))
    often = Counter(w for t in words for w in t)
    assert set(seen["known"].words.tolist()) == {one_hash(w) for w, n in often.items() if 100 * n >= total}
    hashed = lambda w: one_hash(w) if w else int(lm.START)
    pairs = Counter((hashed(v) & 0xFFFFFFFF) << 32 | one_hash(w) & 0xFFFFFFFF for t in words for v, w in zip([None, *t], t))
    assert set(seen["known"].pairs.tolist()) == {k for k, n in pairs.items() if 100 * n >= total} != set()


class Exact:
    """A unigram model by dictionaries over the rows, and the words frequent in them."""

    def __init__(self, rows, target, frequent):
        words = [((t or "").lower().split(), i in target) for i, t in rows]
        self.n = [Counter(one_hash(w.encode()) & 0xFFFFFFFF for ws, g in words for w in ws if g or not k) for k in (0, 1)]
        often = Counter(one_hash(w.encode()) for ws, _ in words for w in ws)
        self.words = np.array([w for w, n in often.items() if n * frequent >= often.total()], dtype=np.uint64)
        self.types = len(often)

    def unigram(self, low):
        return np.array([[(n[w] + 0.5) / (n.total() + 0.5 * self.types) for w in low.tolist()] for n in self.n])


def test_rare_words_have_their_own_counts(spark, make_docs, monkeypatch):
    for name, value in (("FREQUENT", 40), ("BUCKET", 150), ("SLICE", 7)):
        monkeypatch.setattr(lm, name, value)
    rng = random.Random(10)
    rows = [(i, " ".join(["the", *(f"w{int(rng.expovariate(0.05))}" for _ in range(20))] * (1 + i % 2))) for i in range(40)]
    rows += [(100 + i, " ".join(f"x{k}" for k in rng.sample(range(60), 12)) + (" onlygood" if i % 2 else " onlybad")) for i in range(30)]
    target = {i for i, _ in rows if i % 2}
    ids = spark.createDataFrame([(i,) for i in target], "doc_id long")
    model = Exact(rows, target, 40)
    assert 0 < len(model.words) < 10
    want = {i: (n, t, b) for i, n, t, b in brute(rows, target, model)}
    got = lm.score(make_docs(rows).repartition(3), ids).collect()
    assert len(got) == len(rows)
    for r in got:
        n, t, b = want[r["doc_id"]]
        assert r["n_tokens"] == n and r["target_loss"] == pytest.approx(t, abs=2e-5) and r["background_loss"] == pytest.approx(b, abs=2e-5)


def test_frames_are_bounded_by_rows_and_characters():
    """2,000 long texts never meet in one frame; every row comes out once and in order."""
    texts = ["x" * n for n in [70_000] * 300 + [0, 5, 900_000, 3, 200_000] + [40] * 5000] + [None, ""]
    batches = [pd.DataFrame({"text": texts[a : a + 333]}) for a in range(0, len(texts), 333)]
    out = list(frames(iter(batches), 2_000, 250_000))
    assert [t for f in out for t in f["text"]] == texts
    sizes = [f["text"].map(lambda t: len(t or "")).sum() for f in out]
    assert all(len(f) <= 2_000 for f in out) and all(n <= 250_000 or len(f) == 1 for f, n in zip(out, sizes, strict=True))
    assert max(len(f) for f in out) == 2_000  # short texts still fill a frame


def test_a_task_of_long_texts_stays_small():
    """Counting a slice of 27 MB takes memory for one frame at a time."""
    import tracemalloc

    texts = ["some words of a long text " * 2_700] * 400
    batches = (pd.DataFrame({"text": texts[a : a + 50], "target": False}) for a in range(0, len(texts), 50))
    tracemalloc.start()
    n = sum(int(f[f["kind"] == 0]["n"].sum()) for f in lm._find(batches))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 400 * 2_700 * 6 and peak < 400e6
