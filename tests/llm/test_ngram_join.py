import random
import re

import numpy as np
import pytest

from ledgerflow.llm import graph
from ledgerflow.llm import ngram_join as nj


def brute(rows):
    """Set size, component and number of linked documents by all pairs."""

    def shingles(text):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    near = [[False] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            if i != j and sets[i] and sets[j]:
                near[i][j] = 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            k = todo.pop()
            for j in range(n):
                if near[k][j] and j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[k][0] for k in seen if rows[k][0] is not None]
        out.append((rows[i][0], len(sets[i]), (min(ids) if ids else None) if sets[i] else rows[i][0], sum(near[i])))
    return sorted(out, key=str)


def result(docs):
    cols = ("doc_id", "n_shingles", "component_id", "n_links")
    return sorted((tuple(r[c] for c in cols) for r in nj.join(docs).collect()), key=str)


def corpus(seed, families=12, size=4, words=60, passage=None):
    rng = random.Random(seed)
    rows, k = [], 0
    for f in range(families):
        base = [f"f{f}w{rng.randrange(40)}" for _ in range(words)]
        for _ in range(size):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = f"e{rng.randrange(9)}"
            rows.append((k, ("Common line here that all texts share today. " if passage else "") + " ".join(w)))
            k += 1
    return rows


CASES = [
    (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "One TWO"), (6, "one two three"), (None, "one two"), (7, "a b c d e"),
    (7, "a b c d e"), (8, "É b c d e"), (9, "é b c d e"), (None, "lone words without partner here"), (10, "x y " * 5000), (11, "x y " * 5000 + "x z"),
]


def test_defined_cases(make_docs):
    assert result(make_docs(CASES, extra=True)) == brute(CASES)


def test_empty_table(make_docs):
    assert nj.join(make_docs([])).count() == 0
    assert nj.keep_one(make_docs([])).count() == 0


@pytest.mark.parametrize("small", [False, True])
def test_families_equal_brute_force(make_docs, monkeypatch, small):
    if small:  # components larger than a block are searched in pairs of slices
        monkeypatch.setattr(nj, "BLOCK", 300)
        monkeypatch.setattr(nj, "BUCKET", 500)
        monkeypatch.setattr(nj, "FREQUENT", 3)
    rows = corpus(3, families=6, size=12, passage=small)
    assert result(make_docs(rows)) == brute(rows)


def test_divide_skip_equals_brute_force():
    rng = np.random.default_rng(5)
    for heap in (0, 10_000):
        nj.HEAP = heap
        sets = [np.unique(rng.integers(0, 30, rng.integers(1, 25)).astype(np.uint64)) for _ in range(60)]
        sets.sort(key=len)
        every = np.arange(len(sets))
        want = {
            (i, j) for i in range(60) for j in range(i)
            if 100 * len(np.intersect1d(sets[i], sets[j])) >= 80 * len(np.union1d(sets[i], sets[j]))
        }
        assert {(x, y) for x, ys in nj.divide_skip(sets, every, every) for y in ys.tolist()} == want
        half = {(max(x, y), min(x, y)) for x, ys in nj.divide_skip(sets, every[::2], every[1::2]) for y in ys.tolist()}
        assert half == {(i, j) for i, j in want if (i + j) % 2}
    nj.HEAP = 2_000


def test_stage_keeps_one_of_each_group(make_docs):
    docs = make_docs(CASES + [(12, "lone words without partner here")], extra=True)
    kept = nj.keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in kept.collect())
    # equal sets keep their smallest id; texts without a word all stay; nobody is left without a representative
    assert got == sorted([1, 2, 3, 4, 6, 7, 8, 9, 10, 11, 12])


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(200, 260)] + [(None, 3), (5, None), (7, 7)]
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(41)} == {0} and {got[k] for k in range(200, 260)} == {100}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
