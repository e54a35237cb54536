import itertools

import numpy as np
import pytest

from ledgerflow.llm import quality_rules as qr

CLEAN = " ".join(f"word{i} goes with thing{i}." for i in range(20))
JUNK = "\n".join(" ".join(f"a{i}b{j}%%% ***" for j in range(8)) for i in range(9))


def brute_viterbi(e, t):
    best = max(
        itertools.product((0, 1), repeat=len(e)),
        key=lambda p: (sum(e[i][s] for i, s in enumerate(p)) + sum(t[a][b] for a, b in zip(p, p[1:]))),
    )
    return list(best)


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(1)
    for n in range(1, 9):
        e, t = rng.normal(size=(n, 2)), rng.normal(size=(2, 2))
        assert qr.viterbi(e, t).tolist() == brute_viterbi(e, t)
    assert qr.viterbi(np.zeros((0, 2)), np.zeros((2, 2))).tolist() == []
    assert qr.viterbi(np.zeros((3, 2)), np.zeros((2, 2))).tolist() == [0, 0, 0]  # ties: content


def test_repeat_words_equals_brute_force():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 5, 30, 60):
        w = [b"%d" % x for x in rng.integers(0, 3, n)]
        windows = [tuple(w[i : i + 3]) for i in range(n - 2)]
        hit = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(3)}
        assert qr.repeat_words(w) == len(hit)


def test_crf_learns_lines():
    clean, junk = qr.lines_of(CLEAN + "\n" + CLEAN)[0], qr.lines_of(JUNK)[0]
    w, t = qr.fit_crf([(clean, 1)] * 30 + [(junk, 0)] * 30)
    score = np.concatenate([clean, junk]) @ w
    path = qr.viterbi(np.stack([np.zeros_like(score), score], 1), t)
    assert path.tolist() == [0] * len(clean) + [1] * len(junk)
    assert t[0, 0] > t[0, 1] and t[1, 1] > t[1, 0]


def test_base_columns_and_cases(make_docs, make_labels):
    text = "a b\na b\n\n \na b c # $"
    docs = make_docs([(1, text), (2, None), (3, ""), (4, " \t\n"), (5, CLEAN), (5, CLEAN), (None, JUNK), (6, "x " * 20000)])
    rows = qr.judge(docs, make_labels([])).collect()
    by = {r["doc_id"]: r for r in rows}
    assert len(rows) == 8
    r = by[1]
    assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"]) == (9, 9, 2, 1)
    for i in (2, 3, 4):
        assert (by[i]["n_words"], by[i]["base_failed"], by[i]["kept"], by[i]["content_share"]) == (0, True, False, 0.0)
    assert by[5]["kept"] and not by[None]["kept"] and by[None]["n_lines"] == 9
    assert by[6]["n_words"] == 20000 and by[6]["n_repeat_words"] == 20000 and by[6]["base_failed"]


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (1, 0, 0), (2, None, None), (None, 1, 1), (77, 0, 0)]])
def test_stage_keeps_columns(make_docs, make_labels, labels):
    docs = make_docs([(1, CLEAN), (2, JUNK), (3, None)], extra=True)
    kept = qr.keep_content(docs, make_labels(labels))
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1]
    assert qr.keep_content(docs.limit(0), make_labels(labels)).count() == 0


@pytest.mark.parametrize("content", ["0.12, 0.45, ", "=====---- ", "1\t2;\t3.\t", "Some words, "])
def test_letters_are_counted_alike_at_every_length(content):
    few = qr.FEATURES.index("few_letters")
    short, long = (content * n for n in (5, 5000 // len(content) + 1))
    assert len(short) < 4000 < 5000 <= len(long)
    by = [qr.line_features(line, qr.text_words(line), False)[few] for line in (short, long)]
    assert by == [0.0 if content[0] == "S" else 1.0] * 2
