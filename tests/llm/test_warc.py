import hashlib

import pytest

from ledgerflow.llm import warc

BIG, BIG2 = "big payload é " * 100, "x" * 1000


@pytest.fixture()
def make_pages(spark):
    return lambda rows: spark.createDataFrame(rows, "page_id long, url string, html string, address string, first long, row long, bytes long")


def pages(rows):
    return [(*r, "clash", 1, 2, 3) for r in rows]


ROWS = [
    (1, "http://a/1", BIG), (2, "http://a/2\r\nWARC-Type: revisit", BIG), (9, None, BIG), (4, "http://a/4", None), (5, "http://a/5", ""),
    (6, "u", "y" * 999), (7, "u", "y" * 999), (8, "u", BIG2), (None, "u", BIG2), (3, "u", "z" * 200_000), (10, "u", "a\r\n\r\nb"),
    (11, "u", "same" * 300), (11, "u", "same" * 300), (11, "u", "same" * 300),
]


def test_index_equals_brute_force(spark, make_pages):
    found = warc.index(spark, warc.write(make_pages(pages(ROWS)))).collect()
    assert len(found) == len(ROWS)
    last = {}
    for i, _, h in ROWS:
        if i is not None and len((h or "").encode()) >= 1000:
            last[h] = max(i, last.get(h, i))
    want = []
    for i, _, h in ROWS:
        b = (h or "").encode()
        refers = last.get(h) if h in last and last[h] != i else None
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if refers is not None else "response", refers))
    # of the repeated rows one is the response, the others revisit it
    same = [k for k, w in enumerate(want) if w[0] == 11]
    want = [w if k not in same[1:] else (*w[:3], "revisit", 11) for k, w in enumerate(want)]
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_round_trip_and_single_storage(spark, make_pages):
    archive = warc.write(make_pages(pages(ROWS)))
    back = warc.read_pages(spark, archive).collect()
    clean = lambda u: None if u is None else u.replace("\r", "%0D").replace("\n", "%0A")
    assert sorted(((r["page_id"], r["url"], r["html"]) for r in back), key=str) == sorted(
        ((i, clean(u), h or "") for i, u, h in ROWS), key=str
    )
    stored = spark.read.parquet(archive.payloads).collect()
    assert len(stored) == len({h or "" for _, _, h in ROWS})
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["address"] for r in stored)
    for r in warc.records(spark, archive).collect():
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        length = int([x for x in head.split(b"\r\n") if x.startswith(b"Content-Length")][0].split(b": ")[1])
        assert head.startswith(b"WARC/1.1\r\n") and body[length:] == b"\r\n\r\n"


def test_damage_is_noticed(spark, make_pages, tmp_path):
    archive = warc.write(make_pages(pages(ROWS[:1])))
    bad = spark.read.parquet(archive.payloads).selectExpr("address", "cast('other' as binary) AS payload")
    bad.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match="differs from its address"):
        warc.read_pages(spark, warc.Archive(str(tmp_path / "bad"), archive.headers)).collect()


@pytest.mark.parametrize(
    "old, new, message",
    [
        ("Content-Length: 1500", "Content-Length: 1501", "header and payload disagree"),
        ("WARC-Payload-Digest: sha1:", "WARC-Payload-Digest: sha1:0", "disagree"),
        ("WARC-Type: response", "WARC-Type: revisit", "disagree"),
        ("WARC-Refers-To: <urn:page:9>", "WARC-Refers-To: <urn:page:7>", "revisit disagrees"),
    ],
)
def test_damaged_header_fails(spark, make_pages, tmp_path, old, new, message):
    archive = warc.write(make_pages(pages(ROWS)))
    headers = spark.read.parquet(archive.headers).selectExpr("address", f"cast(replace(cast(header as string), '{old}', '{new}') as binary) AS header")
    headers.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(Exception, match=message):
        warc.index(spark, warc.Archive(archive.payloads, str(tmp_path / "bad"))).collect()


def test_lost_payload_fails(spark, make_pages, tmp_path):
    archive = warc.write(make_pages(pages(ROWS)))
    spark.read.parquet(archive.payloads).where("octet_length(payload) <> 1000").write.parquet(str(tmp_path / "few"))
    with pytest.raises(Exception, match="no payload is stored"):
        warc.index(spark, warc.Archive(str(tmp_path / "few"), archive.headers)).collect()


def test_empty_table(spark, make_pages):
    assert warc.index(spark, warc.write(make_pages([]))).count() == 0
