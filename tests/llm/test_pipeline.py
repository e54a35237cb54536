import itertools
import random

import numpy as np
import pytest

import corpus_pipeline as cp
from ledgerflow.llm import mix, quality_rules

from .test_decontaminate import brute as brute_benchmark
from .test_ngram_join import brute as brute_near

CLEAN = ["".join(p) for p in itertools.product("bcdfg", "aeiou", "lmnr", "aeo")]


def rows(seed=1):
    rng = random.Random(seed)
    text = lambda n=80: " ".join(rng.choice(CLEAN) + ("." if k % 9 == 8 else "") for k in range(n))
    out = [(i, text(), "en", rng.choice(["a", "b", None])) for i in range(60)]
    out += [(100 + i, out[0][1], "en", "a") for i in range(30)]  # copies
    out += [(200 + i, out[1][1] + f" extra{i}.", "en", "b") for i in range(5)]  # near copies
    out += [(300 + i, "\n".join("%%% ### " * 9 + f"x{i}y{k}" for k in range(9)), "en", "a") for i in range(5)]  # junk
    out += [(400 + i, text(60) + " " + ITEM + f" end{i}.", "en", "a") for i in range(4)]  # contaminated
    return out + [(500, None, "en", "a"), (501, "", None, None), (502, "too short", "en", "b"), (503, text(5000), "en", "a")]


ITEM = " ".join(f"item{k}" for k in range(20)) + "."


@pytest.fixture()
def sf_dir(spark, make_docs, make_labels, tmp_path):
    make_docs(rows()).write.parquet(str(tmp_path / "documents.parquet"))
    make_labels([]).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return str(tmp_path)


def test_stages_equal_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, held = docs.columns, rows()
    for name, stage in cp.STAGES:
        docs = stage(spark, docs, sf_dir)
        got = docs.collect()
        ids = sorted(r["doc_id"] for r in got)
        if name == "quality_rules":
            w, t = quality_rules.PRIOR, quality_rules.PRIOR_TRANSITION
            keep = []
            for r in held:
                x, counts, _ = quality_rules.lines_of(r[1])
                words = quality_rules.text_words(r[1])
                if len(words) >= 50 and 100 * quality_rules.repeat_words(words) <= 50 * len(words):
                    score = x @ w
                    content = [s == 0 for s in quality_rules.viterbi(np.stack([score * 0, score], 1), t)]
                    if 2 * sum(c for c, ok in zip(counts, content) if ok) >= sum(counts):
                        keep.append(r)
            held = keep
            assert ids == sorted(r[0] for r in held) and not any(300 <= i < 310 or i >= 500 and i != 503 for i in ids)
        elif name == "ngram_jaccard_join":
            near = {i: c for i, _, c, _ in brute_near([(r[0], r[1]) for r in held])}
            held = [r for r in held if near[r[0]] == r[0]]
            assert ids == sorted(r[0] for r in held) and 0 in ids and 100 not in ids
        elif name == "benchmark_decontamination":
            bad = {i for i, *_, dirty in brute_benchmark([(r[0], r[1]) for r in held], [(1, ITEM)]) if dirty}
            held = [r for r in held if r[0] not in bad]
            assert ids == sorted(r[0] for r in held) and len(bad) >= 4
        elif name == "mix_sources":
            words = {r[0]: len(r[1].split()) for r in held}
            taken = {}
            for r in got:
                taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
            assert all(n <= 2 * words[i] for i, n in taken.items())
            assert abs(sum(taken.values()) - 1.5 * sum(words.values())) < mix.BLOCK_WORDS * 6
            mixed = got
        else:
            assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((r["doc_id"], r["text"]) for r in mixed)
            for s in range(24):
                slots = sorted(r["slot"] for r in got if r["shard"] == s)
                assert slots == list(range(len(slots)))
            assert docs.columns == [*columns, "size", "shard", "slot"]
            continue
        assert docs.columns == columns


def test_run_and_empty_table(spark, sf_dir, make_docs, tmp_path):
    assert cp.run(spark, sf_dir).count() > 30
    again = [sorted((r["doc_id"], r["shard"], r["slot"]) for r in cp.run(spark, sf_dir).collect()) for _ in range(2)]
    assert again[0] == again[1]
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(str(tmp_path / "none" / f"{t}.parquet"))
    make_docs([]).write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert cp.run(spark, str(tmp_path / "none")).count() == 0
