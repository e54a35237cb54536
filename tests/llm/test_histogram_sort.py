import zlib

import numpy as np
import pytest

from ledgerflow.llm import histogram_sort as hs


def test_splitters_are_exact(spark):
    rng = np.random.default_rng(3)
    keys = rng.integers(-(2**62), 2**62, 3000)
    sizes = rng.integers(8, 100, 3000)
    df = spark.createDataFrame([(int(k), int(s)) for k, s in zip(keys, sizes)], "_key long, _size long")
    total = int(sizes.sum())
    wanted = [total * i / 7 for i in range(1, 7)]
    found, below, rounds = hs.splitters(df, wanted, [total / 700] * 6)
    for k, b, w in zip(found, below, wanted):
        assert (keys < k).sum() == b
        assert abs(sizes[keys < k].sum() - w) <= total / 700
    assert 1 <= rounds <= 16


def check(rows, n, shards=24):
    assert len(rows) == n
    by = {}
    for r in rows:
        by.setdefault(r["shard"], []).append(r)
    assert all(0 <= s < shards for s in by)
    for own in by.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
    return [sum(r["size"] for r in by.get(s, [])) for s in range(shards)]


@pytest.mark.parametrize("small_ranges", [False, True])
def test_shards_are_even_and_gapless(make_docs, monkeypatch, small_ranges):
    if small_ranges:
        monkeypatch.setattr(hs, "RANGE_BYTES", 500)
    # a third of all rows are copies, another third one repeated row
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(700)] + [(i, "copy of one text " * 3) for i in range(700, 1400)]
    rows += [(5000, "the very same row again and again")] * 700 + [(None, None), (1, ""), (None, "no id")]
    out = hs.shard(make_docs(rows, extra=True))
    bytes_ = check(out.collect(), len(rows))
    assert max(bytes_) - min(bytes_) <= 2 * 60
    plain = make_docs(rows, extra=True)
    assert out.columns == [c for c in plain.columns if c not in ("shard", "slot", "size")] + ["size", "shard", "slot"]


def test_places_do_not_depend_on_partitioning(make_docs, monkeypatch):
    """Copies, repeated rows and distinct texts get the same shard and slot from 3, 5 and 8 input partitions."""
    monkeypatch.setattr(hs, "RANGE_BYTES", 2000)
    rows = [(i, f"text {i} " * (i % 7 + 1)) for i in range(400)] + [(i, "copy of one text " * 3) for i in range(400, 900)]
    rows += [(5000, "repeated row")] * 300 + [(None, "repeated without id")] * 20 + [(None, None), (7, None)]
    docs = make_docs(rows)
    placed = [sorted((str(r["doc_id"]), str(r["text"]), r["shard"], r["slot"]) for r in hs.shard(docs.repartition(n)).collect()) for n in (3, 5, 8)]
    assert placed[0] == placed[1] == placed[2] and len(placed[0]) == len(rows)


def test_many_ranges_cost_the_driver_nothing(make_docs, monkeypatch):
    """Thousands of ranges: the driver still probes for the shards' boundaries only."""
    monkeypatch.setattr(hs, "RANGE_BYTES", 40)
    probed = []
    real = hs.histogram
    monkeypatch.setattr(hs, "histogram", lambda keys, probes: probed.append(len(probes)) or real(keys, probes))
    rows = [(i, f"some text {i} " * 3) for i in range(3000)] + [(i, "one text of many copies") for i in range(3000, 4000)]
    out = hs.shard(make_docs(rows))
    check(out.collect(), len(rows))
    assert max(probed) <= 23 * (hs.PROBES + 2)


def test_cases(make_docs):
    assert hs.shard(make_docs([])).count() == 0
    rows = hs.shard(make_docs([(1, None)])).collect()
    assert [(r["size"], r["slot"]) for r in rows] == [(8, 0)]
    check(hs.shard(make_docs([(1, "x" * 100_000), (2, "é"), (3, None)])).collect(), 3)
    r = hs.shard(make_docs([(2, "é")])).collect()[0]
    assert r["size"] == 10


def test_query_columns(spark, tmp_path, make_docs):
    from ledgerflow.llm.queries import QUERIES

    make_docs([(1, "é"), (2, None)]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r for r in QUERIES["op4_histogram_sort"](spark, str(tmp_path)).collect()}
    assert rows[1]["text_crc32"] == zlib.crc32("é".encode()) and rows[2]["text_crc32"] == 0
    assert rows[1]["law"] == "bytes" and rows[1]["grown_shard"] is None
