import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import language_id as li
from ledgerflow.llm import quality_score as qs
from ledgerflow.llm import toxicity as tx
from ledgerflow.llm.common import fold, text_words

EDGE = [(9001, None), (9002, ""), (9003, " \n"), (9004, "123 %%% 456"), (None, "some words of no id"), (9005, "long text " * 30_000)]


def test_text_words_cut_at_ascii_space_only():
    assert text_words("a b\x0bc\x1cd\n e") == ["a b".encode(), "c\x1cd".encode(), " e".encode()]


def test_folds(spark):
    rows = spark.range(20).select("id", fold(F.col("id"), 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


# quality


def test_isotonic_equals_brute_force():
    rng = np.random.default_rng(0)
    for _ in range(20):
        n = rng.integers(1, 5, 6)
        good = np.minimum(n, rng.integers(0, 5, 6))
        fit = qs.isotonic(np.arange(6.0), good, n)
        assert (np.diff(fit) >= -1e-12).all()
        # the minimum over max-min formula of isotonic regression
        mean = lambda a, b: good[a : b + 1].sum() / n[a : b + 1].sum()
        want = [max(min(mean(a, b) for b in range(i, 6)) for a in range(i + 1)) for i in range(6)]
        assert fit == pytest.approx(want)
    assert len(qs.isotonic(np.zeros(0), np.zeros(0), np.zeros(0))) == 0


def test_normal_equations_are_the_sums(spark):
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, len(qs.STATISTICS))), rng.integers(0, 2, 300)
    f = qs.Fourier(x.mean(0), x.std(0), size=16)
    rows = spark.createDataFrame([(r.tolist(), int(v)) for r, v in zip(x, y)], "x array<double>, label int").repartition(5)
    a, b = qs.normal_equations(rows, f)
    assert np.allclose(a, f(x).T @ f(x)) and np.allclose(b, f(x).T @ y)
    two = qs.Fourier(np.zeros(3), np.ones(3), size=4000)
    p, q = rng.normal(size=(1, 3)) / 2, rng.normal(size=(1, 3)) / 2
    kernel = np.exp(-np.sum((p - q) ** 2) / (2 * qs.BANDWIDTH**2))
    assert (two(p)[:, :-1] @ two(q)[:, :-1].T).item() == pytest.approx(kernel, abs=0.05)


def quality_rows(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [f"w{rng.randrange(400)}" for _ in range(60)]
        good = rng.random() < 0.7
        rows.append((i, " ".join(w if good else w + "%%%" for w in words) + ".", int(good)))
    return rows


def test_quality_held_out_and_cases(make_docs, make_labels):
    rows = quality_rows(400, 2)
    docs = make_docs([r[:2] for r in rows] + EDGE, extra=True)
    labels = make_labels([(i, q, 0) for i, _, q in rows if i % 5] + [(None, 1, 0), (5, None, 0), (8888, 1, 1)])
    stats = qs.describe(docs)
    got = {r["doc_id"]: r["score"] for r in qs.fit(stats, labels).score(stats).collect()}
    assert len(got) == len(rows) + len(EDGE) and all(0 <= s <= 1 for s in got.values())
    held = [(got[i] >= 0.3) == bool(q) for i, _, q in rows if i % 5 == 0]
    assert np.mean(held) > 0.95


def test_quality_without_labels(make_docs, make_labels):
    stats = qs.describe(make_docs([(1, "a b"), (2, None)]))
    assert {r["score"] for r in qs.fit(stats, make_labels([])).score(stats).collect()} == {0.5}
    assert {r["score"] for r in qs.fit(stats, make_labels([(1, 1, 0)])).score(stats).collect()} == {1.0}
    empty = qs.describe(make_docs([]))
    assert qs.fit(empty, make_labels([])).score(empty).count() == 0


# languages

LANGS = {"xx": "ka ke ki ko ku".split(), "yy": "zor zar zur zer".split(), "zz": "mmp nnt rrs lls".split()}


def lang_text(rng, lang, n=40):
    return " ".join("".join(rng.choice(LANGS[lang]) for _ in range(3)) for _ in range(n))


def test_languages(make_docs):
    rng = random.Random(3)
    rows = [(i, lang_text(rng, lang), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 30)]
    train = make_docs([(*r, "s") for r in rows] + [(500, "no language", None, "s"), (501, None, "xx", "s")], extra=True)
    model = li.fit(train)
    assert model.langs == ["xx", "yy", "zz"]
    mixed = lang_text(rng, "xx", 60) + " " + lang_text(rng, "yy", 30)
    test = [(1000 + i, lang_text(rng, lang), lang) for i, lang in enumerate(["zz", "yy", "xx"] * 10)] + [(2000, mixed, "xx")]
    docs = make_docs([(*r, "s") for r in test] + EDGE)
    got = {r["doc_id"]: r for r in li.predict(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang for i, _, lang in test)
    assert set(got[2000]["languages"]) == {"xx", "yy"} and got[2000]["languages"]["xx"] == pytest.approx(360 / 630, abs=0.04)  # letters
    for i in (9001, 9002, 9003, 9004):
        assert (got[i]["lang_pred"], got[i]["score"]) == ("und", 0.0)
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == len(test) + len(EDGE)


def test_em_reaches_the_maximum():
    rng = np.random.default_rng(4)
    model = li.Model(["a", "b"], rng.integers(0, 50, (2, li.GRAMS)).astype(float))
    ids = np.arange(200)
    counts = rng.integers(1, 5, 200)
    share, like = model.proportions(ids, counts, [0, 1])
    grid = [counts @ np.log(t * model.prob[0, ids] + (1 - t) * model.prob[1, ids]) for t in np.linspace(0, 1, 201)]
    assert like >= max(grid) - 0.05 and share.sum() == pytest.approx(1)


def test_no_training_rows(make_docs):
    docs = make_docs([(1, "some text")])
    assert [r["lang_pred"] for r in li.predict(docs, li.fit(docs.limit(0))).collect()] == ["und"]
    assert li.predict(docs.limit(0), li.fit(docs)).count() == 0


# toxicity


def test_folding():
    plain = tx.fold("clown loser")
    assert tx.fold("CLÓWN l0ser") == plain
    assert tx.fold("сlоwn ｌoser") == plain  # Cyrillic letters, full-width letter
    assert tx.fold("c1own 1oser") == plain
    assert tx.fold("year 2024, 10 items") == ["year", "2024", "10", "items".replace("l", "i")]
    assert tx.fold(None) == [] and tx.fold("") == []


def toxic_rows(n, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        words = [f"{rng.choice('abcdefg')}{rng.choice('hjkm')}word{rng.choice('npqr')}" for _ in range(50)]
        bad = rng.random() < 0.3
        for _ in range(3 if bad else 0):
            words.insert(rng.randrange(50), rng.choice(["scumbag", "grimle" + rng.choice(["ta", "to", "sch"])]))
        if not bad and rng.random() < 0.3:
            words[10:10] = ["trashy", "cinema"]
        elif bad:
            words.insert(5, "trashy")
        rows.append((i, " ".join(words), int(bad)))
    return rows


def test_toxicity_held_out_and_cases(make_docs, make_labels):
    rows = toxic_rows(500, 5)
    labels = make_labels([(i, 1, t) for i, _, t in rows if i % 5] + [(None, 1, 1), (3, 1, None)])
    docs = make_docs([r[:2] for r in rows] + EDGE + [(7000, "a gr1mleta and a SCUMBAG in " + "few words " * 10)], extra=True)
    model = tx.fit(docs, labels)
    got = {r["doc_id"]: r["score"] for r in model.score(docs).collect()}
    held = [(got[i] >= 0.7) == bool(t) for i, _, t in rows if i % 5 == 0]
    assert np.mean(held) > 0.95 and got[7000] >= 0.7
    assert all(got[i] < 0.2 for i in (9001, 9002, 9003, 9004, 9005))
    assert len(got) == len(rows) + len(EDGE) + 1


def test_exceptions_cancel_hits():
    matcher = tx.Matcher({" trash ": 2.0, " grim": 3.0}, {" trash can "})
    assert tx.evidence("the trash can".split(), matcher)[0] == 0
    assert tx.evidence("the trash man".split(), matcher)[0] == 1
    assert tx.evidence("a grimly grim pilgrim".split(), matcher)[0] == 2
    assert tx.phrases_of("big trash man".split(), matcher) == {" big trash ", " trash man "}


def test_toxicity_without_labels(make_docs, make_labels):
    docs = make_docs([(1, "a b"), (2, None)])
    assert {r["score"] for r in tx.fit(docs, make_labels([])).score(docs).collect()} == {0.0}
    assert {r["score"] for r in tx.fit(docs, make_labels([(1, 1, 1)])).score(docs).collect()} == {0.0}
    assert tx.fit(docs.limit(0), make_labels([])).score(docs.limit(0)).count() == 0


def test_covered_beginnings_as_in_choose_terms(spark):
    rng = random.Random(11)
    rows = {f" {''.join(rng.choice('ab') for _ in range(rng.randrange(4, 10)))}{rng.choice(['', ' '])}": rng.randrange(20, 40) for _ in range(300)}
    rows = [(t, n, 1) for t, n in rows.items() if t.endswith(" ") or len(t) - 1 in tx.STEMS]
    kept = tx.uncovered(spark.createDataFrame(rows, "term string, toxic long, other long")).collect()
    want = tx.choose_terms(rows, 100, 100)
    assert {r["term"] for r in kept} == set(want) and len(want) < len(rows)


def test_lexicon_is_not_capped(make_docs, make_labels, monkeypatch):
    monkeypatch.setattr(tx, "MAX_TERMS", 40, raising=False)  # a cap, if there is one
    rng = random.Random(12)
    bad, good = ["".join(rng.choice("hjkmnpqr") for _ in range(9)) for i in range(60)], [f"plain{i}text" for i in range(60)]
    rows = [(i, " ".join(rng.sample(bad if i % 2 else good, 30))) for i in range(240)]
    model = tx.fit(make_docs(rows), make_labels([(i, 1, i % 2) for i, _ in rows]))
    for word in bad:
        assert tx.Matcher(model.terms, set()).hits([word]), word


def test_full_readings_undo_every_substitute():
    matcher = tx.Matcher({" shit ": 3.0, " hate ": 2.0, " idiot ": 2.5, " goon ": 1.0}, {" idiot savant "})
    hit = lambda text: tx.evidence(*(lambda words, full: (words, matcher, full))(*tx.readings(text)))[0]
    for text in ("$h1t", "h4t3", "1d10t", "1d107", "1D10T!", "x_h4t3!!", "a h4t3 b 1d10+ c", "900n"):
        assert hit(text) == text.count(" b ") + 1, text
    assert hit("hate! idiot") == 2 and hit("1d10t savant") == 0  # plain hits count once; exceptions hold
    assert all(not hit(t) for t in ("mp3 and b2b in 2024", "4473 $1+1", "hello! wow!!", "", "107 90 x86 " * 3))
    assert tx.fold("mp3 h4t3 hello!") == ["mp3", "hat3", "heiio"]  # the plain words are as before
    assert tx.readings("a" * 200_000 + "!" + "1" * 200_000 + "b7")[1]
    assert tx.phrases_of(*(lambda words, full: (words, matcher, full))(*tx.readings("an 1d10t box"))) == {" an idiot ", " idiot box "}


def disguised_rows(n, seed):
    rng = random.Random(seed)
    swap = str.maketrans("eaoi", "3401")
    # a term of toxic texts that a few harmless ones hold too, always before the same word
    rows = [(i, t if x or i % 9 == 0 else t.replace("trashy cinema", "plain cinema"), x) for i, t, x in toxic_rows(n, seed)]
    return [(i, t if rng.random() < 0.5 else " ".join(w.translate(swap) if rng.random() < 0.2 else w for w in t.split()), x) for i, t, x in rows]


@pytest.mark.parametrize("part", [1, 2])
def test_lexicon_by_parts_equals_the_whole(make_docs, make_labels, monkeypatch, part):
    """With the bound near 0 every term and exception goes through parts, with the same scores."""
    rows = disguised_rows(300, 21)
    labels = make_labels([(i, 1, t) for i, _, t in rows if i % 4])
    docs = make_docs([r[:2] for r in rows] + EDGE + [(7000, "gr1mlet4 and a 5CUMBAG, trashy cinema tr4shy c1nema"), (7000, "scumbag"), (None, "scumbag")], extra=True)
    key = lambda r: (str(r["doc_id"]), r["n_words"], r["n_hits"], round(r["score"], 9))
    plain = tx.fit(docs, labels)
    want = sorted(map(key, plain.score(docs).collect()))
    assert plain.tables is None and plain.exceptions and any(r[2] for r in want)
    monkeypatch.setattr(tx, "LEXICON_PART", part)
    model = tx.fit(docs, labels)
    assert model.tables is not None and model.tables[1] == len(plain.terms) > part and model.tables[3] == len(plain.exceptions)
    assert sorted(map(key, model.score(docs).collect())) == want


def test_hits_equal_a_substring_scan():
    rng = random.Random(22)
    for _ in range(300):
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(1, 12))]
        terms = {}
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(words) if rng.random() < 0.7 else "abab"
            terms[rng.choice([f" {w} ", f" {w[: rng.randint(1, len(w))]}"])] = rng.randint(1, 5) / 2
        exceptions = {f" {rng.choice(words)} {rng.choice(words)} " for _ in range(rng.randint(0, 2))}
        joined, want, at = f" {' '.join(words)} ", {}, 0
        for w in words:  # every term at every word, by comparison
            heavy = [weight for t, weight in terms.items() if joined.startswith(t, at)]
            over = any(joined.startswith(e, k) and k <= at < k + len(e) - 1 for e in exceptions for k in range(len(joined)))
            if heavy and not over:
                want[at] = max(heavy)
            at += len(w) + 1
        assert tx.Matcher(terms, exceptions).hits(words) == want


def test_term_counts_equal_brute_force(spark):
    texts = [("Scumbag scumbags scum", 1), ("scumbag", 1), ("scumbags go", 0), ("", 1), (None, 0), ("SCUMBAG sсumbag", 0)]
    df = spark.createDataFrame(texts, "text string, label int")
    found = df.repartition(3).mapInPandas(tx._count, "term string, toxic long, other long, docs long").groupBy("term").sum("toxic", "other", "docs").collect()
    want = {}
    for text, label in texts:
        words = set(tx.fold(text))
        for term in {f" {w} " for w in words} | {f" {w[:n]}" for w in words for n in tx.STEMS if len(w) > n}:
            n = sum(f" {w} ".startswith(term) and (term.endswith(" ") or len(w) > len(term) - 1) for w in words)
            c = want.setdefault(term, [0, 0, 0])
            c[0 if label else 1] += n
            c[2] += bool(label)
    assert {r[0]: list(r)[1:] for r in found} == want
