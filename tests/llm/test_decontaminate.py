import hashlib
import random
import re

import duckdb
import pandas as pd
import pytest

from ledgerflow.llm import decontaminate as dc

ITEM = " ".join(f"item{i}" for i in range(20))
SHORT = "short item text"


def brute(docs, items):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for name, body in items:
            b = words(body)
            if not b or name is None:
                continue
            k = min(13, len(b))
            for s in range(len(b) - k + 1):
                for p in range(len(w) - k + 1):
                    if w[p : p + k] == b[s : s + k]:
                        hit.update(range(p, p + k))
                        found.add(str(name))
        out.append((i, len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture()
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id long, text string")


def result(docs, items):
    cols = ("doc_id", "n_words", "n_hit", "items", "contaminated")
    return sorted((tuple(r[c] for c in cols) for r in dc.measure(docs, items).collect()), key=str)


ITEMS = [(1, ITEM), (2, ITEM.upper()), (10, SHORT), (4, None), (5, " ,. "), (7, "one"), (8, "a a a a a a a a a a a a a a a a")]
W = ITEM.split()
DOCS = [
    (1, None), (2, ""), (3, "  .. "), (4, ITEM), (4, ITEM), (5, "x " + " ".join(W[3:16]) + " y"), (6, " ".join(W[:12])),
    (None, "before, SHORT-item;text after"), (8, "One"), (9, "a " * 3000), (10, " ".join(W[2:18]) + " gap " + " ".join(W[:14])),
    (11, "pad " * 700 + ITEM), (12, " ".join(W[7:]) + " " + " ".join(W[:13])), (13, "unrelated words only"),
]


def test_defined_cases_equal_brute_force(make_docs, make_items):
    assert result(make_docs(DOCS, extra=True), make_items(ITEMS)) == brute(DOCS, ITEMS)


def test_shuffle_join_gives_the_same(make_docs, make_items, monkeypatch):
    monkeypatch.setattr(dc, "BROADCAST_KEYS", 0)
    assert result(make_docs(DOCS), make_items(ITEMS)) == brute(DOCS, ITEMS)


def test_shuffled_probes_on_a_long_text(make_docs, make_items, monkeypatch):
    """A text of 60,000 words with an item every 300: the candidates' way gives what the broadcast way gives."""
    items = [(i, " ".join(f"i{i}w{k}" for k in range(15))) for i in range(200)]
    text = " ".join("plain words " * 142 + items[i % 200][1] for i in range(200))
    docs = [(1, text), (2, "other words"), (3, text[:200_000]), (3, text[:200_000])]
    want = result(make_docs(docs), make_items(items))
    monkeypatch.setattr(dc, "BROADCAST_KEYS", 0)
    assert result(make_docs(docs), make_items(items)) == want
    assert {r[0]: r[2] for r in want}[1] == 200 * 15


def test_empty_tables(make_docs, make_items):
    assert dc.measure(make_docs([]), make_items(ITEMS)).count() == 0
    rows = result(make_docs(DOCS), make_items([]))
    assert len(rows) == len(DOCS) and not any(r[4] or r[2] for r in rows)


def test_random_texts_equal_oracle(make_docs, make_items):
    rng = random.Random(4)
    vocab = [f"v{i}" for i in range(3)]
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([2, 5, 12, 13, 14, 18])))) for i in range(12)]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(80))) + f" {rng.choice(items)[1]}") for i in range(40)]
    got = result(make_docs(docs), make_items(items))
    assert got == brute(docs, items)
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    rows = con.sql(dc.ORACLE).df().sort_values("doc_id").itertuples(index=False)
    want = sorted(((r.doc_id, r.n_words, r.n_hit, r.items_sha256, r.contaminated) for r in rows))
    mine = sorted((r[0], r[1], r[2], hashlib.sha256(",".join(r[3]).encode()).hexdigest(), r[4]) for r in got)
    assert mine == want


def test_stage_drops_only_contaminated(make_docs, make_items):
    docs = make_docs(DOCS, extra=True)
    kept = dc.drop_contaminated(docs, make_items(ITEMS))
    assert kept.columns == docs.columns
    want = [r[0] for r in brute(DOCS, ITEMS) if not r[4]]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)


def test_main_path_has_no_python(make_docs, make_items):
    plan = dc.measure(make_docs(DOCS), make_items(ITEMS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
