import hashlib
import random
import re

import pytest

from ledgerflow.llm import secret_link
from ledgerflow.llm.common import prepare

KINDS = ["assign", "access", "hex", "secret", "pass", "login", "endpoint"]
KEY = "wJalrXUtnFEMIK7MDENGbPxRfiCYEXAMPLEKEY01"


def spans_of(text):
    """Spans of each kind by Python's own matcher, contract patterns as written there."""
    out = {k: [] for k in KINDS}
    for m in re.finditer(r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            out["assign"].append(m.span())
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 20), ("hex", "[0-9a-f]+", 24)):
        out[kind] = [m.span() for m in re.finditer(pattern, text) if len(m[0]) >= least]
    for m in re.finditer(r"[A-Za-z0-9+/]{40,}", text):
        if len(m[0]) == 40 and re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0]):
            out["secret"].append(m.span())
    for kind in ("pass", "login", "endpoint"):
        out[kind] = [m.span() for m in re.finditer(secret_link.PATTERNS[kind], text)]
    return out


def brute(text):
    text = text or ""
    spans = spans_of(text)
    ends = [m.end() for m in re.finditer(r"\n[ \t\r]*\n", text)]
    scope = lambda s: sum(e <= s[0] for e in ends)
    near = lambda a, kind: min(((abs(p[0] - a[0]), p) for p in spans[kind] if scope(p) == scope(a) and abs(p[0] - a[0]) <= 256), default=None)
    base = [(s, KINDS.index(k), e) for k in KINDS[:3] for s, e in spans[k]]
    weak = set()
    for anchor, needed in (("secret", ["access"]), ("assign", ["login", "endpoint"]), ("pass", ["login", "endpoint"])):
        for a in spans[anchor]:
            met = [near(a, k) for k in needed]
            if all(met):
                weak |= {(a[0], KINDS.index(anchor), a[1])} | {(p[1][0], KINDS.index(k), p[1][1]) for k, p in zip(needed, met, strict=True)}
    line = lambda rows: ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(rows))
    counts = [sum(k == i for _, k, _ in base) for i in range(3)]
    return (*counts, hashlib.sha256(line(base).encode()).hexdigest(), line({*base, *(w for w in weak if w[1] > 2)}))


def run(docs):
    prepare(docs.sparkSession)
    rows = secret_link.Scan(docs).report().select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans").collect()
    return sorted((tuple(r) for r in rows), key=repr)


FILL = "plain prose goes on here, "
TEXTS = [
    None, "", "no secrets", "é" * 30 + " Password: 'héé", 'TOKEN = "abcdef.12"', "secret=token:abcdef", "token=abc token=abcdef",
    "api_key:'" + "0a" * 20 + "' apikey=abcde", "x" + "0123456789abcdef" * 2 + "g", "AKIA" + "Z" * 15 + " AKIA" + "Z" * 16 + " AKIAAKIA" + "0" * 30,
    f"key AKIA{'Q' * 16} and {KEY} end", f"{KEY} alone", f"AKIA{'Q' * 16}{' ' * 300}{KEY}", f"AKIA{'Q' * 16}\n \t\n{KEY}", f"AKIA{'Q' * 16}\n{KEY}x",
    "host: db.example.org\nuser = bob\npwd: hunter2!", "host: db.example.org\n\nuser = bob\npwd: hunter2!", "user=bob pwd=hunter2",
    "postgres://db.example:5432/x user_id:'amy' password=letmein99 " + FILL * 20 + "user=far",
    "émigré " * 9 + "https://höst.example login=" + "ann@x.org " + 'PASSWD="pässword" secret : abcdefg',
    "\n\n\nuser=a1\n\n\nuser=b2 server=s3 auth=q1w2e3 auth=r4t5 " * 3, "password=" + "\x85" + "abcdefg", "paſsword=abcdefg toKen=abcdefg",
]


@pytest.mark.parametrize("extra", [False, True])
def test_equals_brute_force(make_docs, extra):
    rows = list(enumerate(TEXTS)) + [(None, TEXTS[10]), (3, TEXTS[3]), (3, TEXTS[3])]
    found = run(make_docs(rows, extra).repartition(3))
    assert found == sorted(((i, *brute(t)) for i, t in rows), key=repr)
    linked = {r[0]: r[5] for r in found}
    assert "secret:" in linked[10] and not any("secret:" in linked[i] for i in (11, 12, 13, 14))
    assert "pass:" in linked[15] and linked[16] == linked[17] == "" and linked[18].count("login:") == 1


def test_random_parts(make_docs):
    rng = random.Random(3)
    bits = [f"AKIA{'7' * 16}", KEY, "user=u9", "pwd=zzzz", "token=abcdef", "https://a.b/c", "server:x.y", "\n\n", "\n \n", " word ", FILL * 3, "0f" * 13, "é", '"', "="]
    rows = [(i, " ".join(rng.choices(bits, k=rng.randint(1, 60)))) for i in range(300)]
    assert run(make_docs(rows)) == sorted(((i, *brute(t)) for i, t in rows), key=repr)


def test_long_text_with_many_matches(make_docs):
    rows = [(1, ("user=abc pwd=qwert host=h.example " + FILL) * 3000), (2, "password=abcdef " * 20_000), (3, "a" * 1_000_000), (4, "0" * 500_000)]
    assert run(make_docs(rows)) == sorted(((i, *brute(t)) for i, t in rows if i != 1), key=repr)[:0] + sorted(((i, *brute_long(t)) for i, t in rows), key=repr)


def brute_long(text):
    """``brute`` with positions searched only nearby (one paragraph, parts of a period)."""
    if not text.startswith("user="):
        return brute(text)
    spans = spans_of(text)
    period = len(text) // 3000
    assert all(len(spans[k]) == 3000 for k in ("login", "pass", "endpoint")) and period < 256
    line = ",".join(f"{k}:{s}:{e}" for s, k, e in sorted((s, k, e) for k in ("login", "pass", "endpoint") for s, e in spans[k]))
    return (0, 0, 0, hashlib.sha256(b"").hexdigest(), line)


def test_empty_table_and_no_python(make_docs):
    docs = make_docs([])
    prepare(docs.sparkSession)
    scan = secret_link.Scan(docs)
    assert scan.report().collect() == [] and scan.links().collect() == []
    plan = scan.report()._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
