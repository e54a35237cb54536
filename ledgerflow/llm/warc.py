"""WARC: content-addressed archive of web pages.

Every page row becomes a WARC record. Payload bytes are stored once per content
under their SHA-256 address; record headers are stored apart, byte for byte, with
the address of their payload. Records are put together again by joining the two,
and the bytes that come back must have the digest they are stored under.

Of records with equal payloads of at least :data:`REVISIT_BYTES` bytes, that
with the largest page_id is the response, all others are revisits of it; smaller
payloads are always responses (and still stored once).

Digests are combined before the shuffle, so a payload that a third of all pages
share is one row per task from there on; headers join small tables of one row per
payload, which Spark splits where many headers have the same address.

Defined cases: a null html is an empty payload; a null url leaves out the target
line; line breaks in a url are percent-encoded; a null page_id is the smallest and
reads back as null; of repeated rows one is the response; an empty table gives an
empty archive; other columns are not archived.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.session import scratch_path

from .common import materialize

REVISIT_BYTES = 1000
#: Record format (fixed values of the standard).
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
NO_ID = "none"
DATE = "1970-01-01T00:00:00Z"


@dataclass(frozen=True)
class Archive:
    """Folders of an archive on shared storage."""

    payloads: str
    headers: str


def _record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit(NO_ID)), F.lit(">"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing where the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write(pages: DataFrame, path: str | None = None, date: str = DATE) -> Archive:
    """Archive (page_id, url, html) rows below ``path`` (default: the shared scratch folder)."""
    path = path or scratch_path(pages.sparkSession, "warc")
    archive = Archive(f"{path}/payloads", f"{path}/headers")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select("page_id", "url", payload.alias("payload")).withColumn("address", F.sha2("payload", 256))
    records.select("address", "payload").dropDuplicates(["address"]).write.parquet(archive.payloads)

    facts = materialize(
        records.select(
            "page_id", "url", "address", F.sha1("payload").alias("sha1"),
            F.octet_length("payload").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("row"),
        ),
        "warc-facts",
    )
    first = (
        facts.where(F.col("bytes") >= REVISIT_BYTES)
        .groupBy("address").agg(F.max(F.struct("page_id", "row")).alias("first"))
    )
    facts = facts.join(first, "address", "left")
    revisit = F.coalesce(F.col("first.row") != F.col("row"), F.lit(False))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"{VERSION}\r\n"),
        _line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _line("WARC-Record-ID", _record_id(F.col("page_id"))),
        _line("WARC-Target-URI", url),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Refers-To", F.when(revisit, _record_id(F.col("first.page_id")))),
        _line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
        F.lit("\r\n"),
    )
    facts.select("address", header.cast("binary").alias("header")).write.parquet(archive.headers)
    return archive


def _tables(spark: SparkSession, archive: Archive) -> tuple[DataFrame, DataFrame]:
    payloads = spark.read.schema("address string, payload binary").parquet(archive.payloads)
    same = F.sha2("payload", 256) == F.col("address")
    checked = F.when(same, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("stored payload differs from its address "), F.col("address"))).cast("binary")
    )
    return payloads.select("address", checked.alias("payload")), spark.read.schema("address string, header binary").parquet(archive.headers)


def field(header: Column, name: str) -> Column:
    """Value of a header field, null where it is absent."""
    value = F.regexp_extract(header.cast("string"), rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(header.cast("string").contains(f"\r\n{name}: "), value)


def _page(record_id: Column) -> Column:
    name = F.regexp_extract(record_id, r"^<urn:page:(.*)>$", 1)
    return F.when(name != NO_ID, name).cast("long")


def records(spark: SparkSession, archive: Archive) -> DataFrame:
    """Whole records as they stand in a WARC file: address, record (header, payload of responses, end).

    Only responses carry a payload, so only they meet the payload table; a response
    whose payload is not stored is an error.
    """
    payloads, headers = _tables(spark, archive)
    response = field(F.col("header"), "WARC-Type") == "response"
    end = F.lit(b"\r\n\r\n")
    absent = F.raise_error(F.concat(F.lit("no payload is stored for "), headers["address"])).cast("binary")
    whole = headers.where(response).join(payloads, "address", "left")
    whole = whole.select("address", F.concat("header", F.coalesce("payload", absent), end).alias("record"))
    return whole.unionAll(headers.where(~response).select("address", F.concat("header", end).alias("record")))


def read_pages(spark: SparkSession, archive: Archive) -> DataFrame:
    """The archived pages, revisits with the payload they refer to: page_id, url, html."""
    payloads, headers = _tables(spark, archive)
    h = F.col("header")
    return headers.join(payloads, "address").select(
        _page(field(h, "WARC-Record-ID")).alias("page_id"), field(h, "WARC-Target-URI").alias("url"),
        F.col("payload").cast("string").alias("html"),
    )


def parse(whole: DataFrame) -> DataFrame:
    """Rebuilt records taken apart: address, header, body, payload_bytes, payload_digest (of the body).

    The header ends at the first empty line; the body is what follows, without the
    record's end. A body whose length is not the header's Content-Length, or a
    response whose digest is not the header's, is an error.
    """
    text = F.col("record").cast("string")
    at = F.instr(text, "\r\n\r\n")
    cut = whole.select("address", F.substring(text, F.lit(1), at + 1).alias("header"), F.substring(text, at + 4, F.length(text) - at - 7).alias("body"))
    cut = cut.select("*", F.octet_length("body").cast("long").alias("payload_bytes"), F.sha1(F.col("body").cast("binary")).alias("payload_digest"))
    h = F.col("header")
    named = field(h, "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    sound = (field(h, "Content-Length") == F.col("payload_bytes").cast("string")) & (named | (field(h, "WARC-Type") == "revisit"))
    checked = F.when(sound, h).otherwise(F.raise_error(F.concat(F.lit("header and payload disagree in record "), field(h, "WARC-Record-ID"))).cast("string"))
    return cut.withColumn("header", checked)


def index(spark: SparkSession, archive: Archive) -> DataFrame:
    """Per record, read back from the rebuilt records: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit takes size and digest from the response it refers to, found by the
    address (of payloads large enough to be revisited there is one response each);
    a digest other than the one in the revisit's header is an error.
    """
    h = F.col("header")
    parsed = parse(records(spark, archive)).select(
        "address", _page(field(h, "WARC-Record-ID")).alias("page_id"), "payload_bytes", "payload_digest",
        field(h, "WARC-Type").alias("record_type"), field(h, "WARC-Refers-To").alias("refers"), field(h, "WARC-Record-ID").alias("record_id"),
        field(h, "WARC-Payload-Digest").alias("named"),
    )
    parsed = materialize(parsed, "warc-index")  # facts only: the payloads stay behind
    responses = parsed.where("record_type = 'response'")
    firsts = responses.where(F.col("payload_bytes") >= REVISIT_BYTES).select(
        "address", F.col("record_id").alias("refers"), F.col("payload_bytes").alias("bytes"), F.col("payload_digest").alias("sha1"), F.col("page_id").alias("first")
    )
    again = parsed.where("record_type = 'revisit'").join(firsts, ["address", "refers"], "left")
    agrees = F.coalesce(F.col("named") == F.concat(F.lit("sha1:"), F.col("sha1")), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("revisit disagrees with what it refers to: "), F.col("record_id"))).cast("string")
    again = again.select("page_id", F.col("bytes").alias("payload_bytes"), F.when(agrees, F.col("sha1")).otherwise(wrong).alias("payload_digest"), "record_type", F.col("first").alias("refers_to"))
    return responses.select("page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to")).unionByName(again)


#: DuckDB has sha1() over UTF-8 text; page ids are distinct in the given tables.
ORACLE = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n FROM pages),
last AS (SELECT body, max(page_id) AS last_id FROM p WHERE n >= 1000 GROUP BY body)
SELECT p.page_id AS page_id, n AS payload_bytes, sha1(p.body) AS payload_digest,
       CASE WHEN last_id IS NOT NULL AND last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last_id IS NOT NULL AND last_id <> page_id THEN last_id END AS refers_to
FROM p LEFT JOIN last USING (body)
"""
