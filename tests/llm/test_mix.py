from collections import Counter

import numpy as np
import pytest

from ledgerflow.llm import mix as m


def test_targets_water_fill():
    # 5 : 2 : 1 of 150 % of 400 words; nobody above twice its size
    got = m.targets([100, 100, 200], [5, 2, 1], 600)
    assert got[:2] == [200, 200] and got[2] == pytest.approx(200)
    assert m.targets([10, 0, 30], [5, 2, 1], 20) == pytest.approx([20 * 5 / 6, 0, 20 / 6])
    assert m.targets([], [], 0) == [] and m.targets([0, 0], [1, 1], 0) == [0, 0]
    assert sum(m.targets([7, 50, 9, 80], [5, 2, 1, 5], 219)) == pytest.approx(219)


def test_permutation_is_one():
    for n in (1, 2, 3, 7, 64, 100, 1000):
        for key in (0, 5, 99):
            got = m.permute(np.arange(n), np.full(n, n), np.full(n, key))
            assert sorted(got.tolist()) == list(range(n))
    mixed = m.permute(np.arange(1000), np.full(1000, 1000), np.full(1000, 3))
    assert np.abs(np.corrcoef(np.arange(1000), mixed)[0, 1]) < 0.2


def test_shard_counts_meet_quotas():
    quota = np.array([1000, 0, 37, 500])
    counts = m.shard_counts(quota, 100)
    assert counts.sum(axis=0).tolist() == quota.tolist() and (counts >= 0).all()
    assert (counts.sum(axis=1)[:-1] == 100).all()
    assert m.shard_counts(np.array([], dtype=int), 10).shape[0] == 0


def docs_rows():
    rows = [(i, f"w{i} " * (i % 90 + 1), "en", ["a", "b", None, "Z"][i % 4]) for i in range(300)]
    rows += [(900, None, "en", "a"), (901, "", "en", "only-empty"), (902, "x " * 30_000, "en", "b"), (None, "no id " * 40, "en", "a")]
    return rows + [(903, "same row here", "en", "a")] * 3


def test_taken_by_source_and_document(make_docs):
    mix = m.Mix(make_docs(docs_rows(), extra=True), block=16, shard_slots=500)
    rows = mix.taken().collect()
    assert len(rows) == len(docs_rows())
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(r["source_size"] == sizes[r["source"]] for r in rows)
    assert sum(target.values()) == pytest.approx(1.5 * sum(sizes.values()))
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = m.targets([sizes[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(sizes.values()))
    assert [target[s] for s in order] == pytest.approx(want)
    assert all(abs(taken[s] - target[s]) <= max(32, 0.02 * target[s]) for s in order)
    again = m.Mix(make_docs(docs_rows()), block=16, shard_slots=500).taken().collect()
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, again))


def test_blocks_are_joined_whole(make_docs):
    """Every slot gives its block's words; blocks of a source are taken evenly."""
    mix = m.Mix(make_docs(docs_rows()), block=16, shard_slots=500)
    slots = mix.slots.collect()
    per = {}
    for s in slots:
        per.setdefault(s["src"], Counter())[s["block"]] += 1
    for src, c in per.items():
        blocks = int(mix.sources["blocks"][src])
        times = [c[b] for b in range(blocks)]
        assert max(times) - min(times) <= 1 and max(times) <= 2
    pieces = mix.pieces().groupBy("src", "block").agg({"end": "sum", "begin": "sum"}).collect()
    full = Counter(r["sum(end)"] - r["sum(begin)"] for r in pieces)
    assert max(full) == 16 and full[16] >= len(pieces) - len(mix.sources)


def test_mixed_documents(make_docs):
    docs = make_docs(docs_rows(), extra=True)
    out = m.mixed_documents(docs)
    assert out.columns == docs.columns
    mix = m.Mix(docs)
    taken = sum(r["taken"] for r in mix.taken().collect())
    rows = out.collect()
    assert sum(len(r["text"].encode().split()) for r in rows) == taken
    assert all(r["n_chars"] == len(r["text"]) for r in rows)
    assert m.mixed_documents(make_docs([])).count() == 0
    assert m.Mix(make_docs([])).taken().count() == 0
    assert m.mixed_documents(make_docs([(1, None), (2, " ")])).count() == 0


def test_taken_equals_a_recount_of_the_slots(make_docs):
    """Each source's stream, blocks and permutation by hand, from the slots' own list of blocks."""
    rows = docs_rows()
    mix = m.Mix(make_docs(rows), block=16, shard_slots=500)
    placed = mix.placed.collect()
    streams = {}
    for r in placed:  # the words of a source's stream, by the document they belong to
        own = streams.setdefault(r["src"], {})
        for k in range(r["size"]):
            assert own.setdefault(r["start"] + k, (r["doc_id"], r["text_key"], r["copy"])) == (r["doc_id"], r["text_key"], r["copy"])
    for src, own in streams.items():
        assert sorted(own) == list(range(int(mix.sources["size"][src])))  # no gap, no overlap
    taken, per = Counter(), Counter()
    slots = mix.slots.collect()
    for s in slots:
        per[s["src"]] += 1
        for k in range(s["block"] * 16, s["block"] * 16 + 16):
            if k in streams[s["src"]]:
                taken[streams[s["src"]][k]] += 1
    got = Counter()
    for r in mix.taken().collect():
        got[r["doc_id"], r["text_key"]] += r["taken"]
    want = Counter()
    for (doc, text, _), n in taken.items():
        want[doc, text] += n
    assert {k: n for k, n in got.items() if n} == want
    for src, n in per.items():  # turn after turn through all blocks, in the permuted order
        blocks, key = int(mix.sources["blocks"][src]), [r["key"] for r in mix.table.collect() if r["src"] == src][0]
        k = np.arange(n)
        order = m.permute(k % blocks, np.full(n, blocks), np.full(n, key))
        assert Counter(zip((k // blocks).tolist(), order.tolist())) == Counter((s["turn"], s["block"]) for s in slots if s["src"] == src)


def test_slots_are_made_in_many_tasks(make_docs, monkeypatch):
    monkeypatch.setattr(m, "SLOTS_PER_TASK", 50)
    monkeypatch.setattr(m, "SHARD_GROUP", 2)
    mix = m.Mix(make_docs(docs_rows()), block=16, shard_slots=100)
    rows = mix.slots.withColumn("task", m.F.spark_partition_id()).groupBy("task").count().collect()
    total = sum(r["count"] for r in rows)
    assert len(rows) >= 20 and max(r["count"] for r in rows) < total / 4
    shards = Counter(r["shard"] for r in mix.slots.collect())
    assert sorted(shards) == list(range(len(shards))) and all(shards[k] == 100 for k in list(sorted(shards))[:-1])
