import hashlib
import math
import random
import zlib

import pytest

from ledgerflow.llm import prefix_trie
from ledgerflow.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    """The contract with lists and a dictionary of prefixes."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    members = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        built = own.get(c - int(math.fmod(c, 20)), [])[:h] + turns[h:]
        for d in range(len(built) + 1):
            members.setdefault(tuple(built[:d]), []).append((c, len(built) == d))
    out = {}
    for p, ms in members.items():
        below = [q for q in members if q[: len(p)] == p]
        words = lambda q: len(q[-1][1].translate(str.maketrans("\t\n\v\f\r", "     ")).replace("\x85", "x").split(" ")) if q else 0
        words = lambda q: len([w for w in q[-1][1].translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]) if q else 0
        ends = ",".join(str(c) for c, end in sorted(ms) if end)
        out[min(ms)[0], len(p)] = (
            min(members[p[:-1]])[0] if p else None, len(ms), sum(len(q) == len(p) + 1 for q in below),
            sum(not any(len(r) == len(q) + 1 and r[:-1] == q for r in below) for q in below), sum((len(members[q]) - 1) * words(q) for q in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        )
    return out


def run(df, **kw):
    prepare(df.sparkSession)
    found = prefix_trie.build(df, **kw).collect()
    out = {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in found}
    assert len(out) == len(found)
    return out


def corpus(seed, convs=70, letters=2, longest=9):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-25, 130), convs):
        for t in range(rng.randint(1, longest)):
            rows.append((c, t, rng.choice(["u", "a"][:letters]), "w " * rng.randint(1, letters)))
    return rows


@pytest.mark.parametrize("component", [1, 8, prefix_trie.COMPONENT])
@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, component):
    rows = corpus(seed)
    assert run(spark.createDataFrame(rows, SCHEMA).repartition(5), component=component) == brute(rows)


def test_defined_cases(spark):
    rows = [
        (None, 1, "u", "no conversation"), (20, None, None, None), (20, None, "", ""), (20, 1, "u", "a\x85b\tc"), (20, 1, "u", "a\x85b\tc"),
        (21, 3, "a", "x"), (22, 3, "a", "x"), (23, 0, "u", "tied"), (23, 0, "a", "tied"), (41, 0, "u", "base is absent"), (41, 1, "u", "too"),
        (1, 5, "1:u", "x"), (2, 5, "1", ":ux"), (-21, 0, "u", "y"), (-20, 0, "u", "y"), (-20, 1, "u", "z"),
    ] + [(c, 0, "u", "one") for c in range(60, 100)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS depth", "2 AS hi", "3 AS n_convs", "4 AS len")
    found = run(df)
    assert found == brute(rows)
    assert any(d == 0 and v[-1] != hashlib.sha256(b"").hexdigest() for (_, d), v in found.items())  # turnless conversations end in the root


def test_empty_and_turnless_tables(spark):
    assert run(spark.createDataFrame([], SCHEMA)) == {} == run(spark.createDataFrame([(None, 0, "u", "t")], SCHEMA))
    lone = next(c for c in range(1, 99) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(lone, 0, "u", "only")]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows) == {(lone, 0): (None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())}


@pytest.mark.parametrize("component", [64, prefix_trie.COMPONENT])
def test_hot_conversation_and_hot_copies(spark, component):
    """One conversation with most turns, over all tasks; many copies of another; a long chain is split by halves."""
    rows = [(200, t, "u", f"turn {t}") for t in range(600)] + [(c, t, "a", f"copy {t}") for c in range(400, 700) for t in range(3)]
    rows += [(c, t, "u", f"turn {t}") for c in (201, 204) for t in range(300)]
    found = run(spark.createDataFrame(rows, SCHEMA).repartition(7), component=component)
    assert found == brute(rows)


def test_turns_cross_tasks(spark):
    rows = [(c, t, "u", f"{c} {t}") for c in (0, 20) for t in range(500)]
    prepare(spark)
    turns = prefix_trie.number_turns(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    for c in (0, 20):
        h, own = 0, sorted((r.at, r.hi, r.lo, r.b_hi, r.b_lo) for r in turns if r.conv_id == c)
        for t in range(500):
            digest = hashlib.sha256(f"1:u{c} {t}".encode()).digest()[:15]
            before, h = h, (h * prefix_trie.BASE + 1 + int.from_bytes(digest, "big")) % prefix_trie.PRIME
            assert own[t] == (t, *prefix_trie._cut(h), *prefix_trie._cut(before))


def test_ends_stream_in_numeric_order(spark):
    rows = [(c, 0, "u", "same") for c in range(0, 4000, 20)]
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    found = prefix_trie.build(spark.createDataFrame(rows, SCHEMA)).where("depth = 1").first()
    prepare(spark)
    assert found.ends_sha256 == hashlib.sha256(",".join(str(c) for c in range(0, 4000, 20)).encode()).hexdigest()
