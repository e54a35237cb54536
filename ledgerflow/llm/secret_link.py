"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong kinds (``assign``, ``access``, ``hex``) are reported wherever they match. Weak
kinds mean little alone and are reported only as part of a credential whose
complementary parts co-occur (:data:`CREDENTIALS`): a bare 40-character token with an
access identifier, a key with a login and an endpoint.

1. *Scan.* Every text is searched once per kind, the weak ones only where the kinds
   they need are present. What lies between the matches (``split``) and the matches
   (``regexp_extract_all``) give lengths; lengths, not texts, leave the scan.
2. *Spans.* Running sums of those lengths per document and kind.
3. *Scopes.* Paragraphs, the intervals between blank lines. An interval join puts each
   part into its scope: both are dealt to buckets of :data:`REACH` characters.
4. *Links.* An interval join of keys (anchors) with parts of the same scope that start
   within :data:`REACH` characters, again by bucket. Spans of a kind don't overlap, so
   an anchor meets a bounded number of parts; the nearest of each role counts. An
   anchor with all its roles is a credential.

Patterns match leftmost and without overlap, per kind; offsets are code points, ends
exclusive; kinds may overlap each other. Defined cases: a null text is empty; texts
without a match give counts of 0, the hash of no bytes and no spans; repeated rows are
scanned each and give a row each, null ids too; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize


def either_case(pattern: str) -> str:
    """``pattern`` with each ASCII letter outside brackets in either case (no flag: its meaning differs by engine)."""
    parts = re.split(r"(\[[^\]]*\]|\\x[0-9A-F]{2})", pattern)
    return "".join(p if i % 2 else re.sub("[A-Za-z]", lambda m: f"[{m[0].upper()}{m[0].lower()}]", p) for i, p in enumerate(parts))


SIGN = r"""["']?\x20*[:=]\x20*["']?"""
#: Kinds in their order. assign, access and hex are the contract's (fixed values); a match of
#: access or hex that is too short holds no longer one, so their least length is in the pattern.
PATTERNS = {
    "assign": either_case("(password|passwd|secret|token|api_?key)") + SIGN + "([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]{16,}",
    "hex": "[0-9a-f]{24,}",
    "secret": "[A-Za-z0-9+/]{40,}",
    "pass": either_case("(?:pwd|pass|pin|auth|credentials?)") + SIGN + "[A-Za-z0-9!@#$%^&*+/_.=-]{4,}",
    "login": either_case("(?:user(?:name|_?id)?|login|account|client_?id)") + SIGN + "[A-Za-z0-9@._+-]{2,}",
    "endpoint": either_case("(?:https?|s?ftps?|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqps?|smtps?|ldaps?|s3)://") + "[A-Za-z0-9._~%@:/?#&=+-]{3,}"
    + "|" + either_case("(?:host(?:name)?|endpoint|server)") + SIGN + "[A-Za-z0-9._:-]{3,}",
}
KINDS = list(PATTERNS)
STRONG = KINDS[:3]
#: A text without any of these (in lower case) has no match of the kind.
KEYWORDS = {
    "assign": ("password", "passwd", "secret", "token", "api"), "access": ("akia",), "login": ("user", "login", "account", "client"),
}
#: Blank lines part the scopes.
BLANK = r"\n[\x20\t\r]*\n"
#: Characters between the starts of an anchor and a part that belongs to it.
REACH = 256
ASSIGN_VALUE, SECRET_SIZE = 6, 40
#: Credential: kinds that anchor it, and the kinds that must co-occur.
CREDENTIALS = {"key_pair": (("secret",), ("access",)), "account": (("assign", "pass"), ("login", "endpoint"))}


def _hits(text: Column, kind: str) -> tuple[Column, Column, Column]:
    """Lengths of the pieces around the matches, lengths of the matches, and whether each counts."""
    pattern = PATTERNS.get(kind, BLANK)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    if kind == "assign":
        good = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda v: F.length(v) >= ASSIGN_VALUE)
    elif kind == "secret":
        good = F.transform(found, lambda m: (F.length(m) == SECRET_SIZE) & m.rlike("[a-z]") & m.rlike("[A-Z]") & m.rlike("[0-9]"))
    else:
        good = F.transform(found, lambda m: F.lit(True))
    return F.transform(F.split(text, pattern, -1), F.length), F.transform(found, F.length), good


def _listed(index: int, kind: str) -> Column:
    """The hits of a kind as an array of (kind, at, gap, size, good); the last gap has no match."""
    zipped = F.arrays_zip(f"{kind}_gap", f"{kind}_size", f"{kind}_good")

    def one(z: Column, at: Column) -> Column:
        return F.struct(F.lit(index).alias("kind"), at.alias("at"), *(z[f"{kind}_{c}"].alias(c) for c in ("gap", "size", "good")))

    return F.transform(zipped, one)


class Scan:
    """Scan of ``docs`` (doc_id, text): ``rows``, ``spans``, ``links()`` and ``report()``.

    ``rows`` has a row per document: uid (a number of the row), doc_id, n_chars and hits.
    ``spans`` has uid, kind (its index in :data:`KINDS`; the next number: blank line), start, end.
    """

    def __init__(self, docs: DataFrame) -> None:
        text, folded = F.coalesce("text", F.lit("")), F.lower(F.coalesce("text", F.lit("")))
        # plain substrings first: only texts that hold a keyword are searched by pattern
        may = {k: reduce(or_, (F.contains(folded, F.lit(w)) for w in words)) for k, words in KEYWORDS.items()}
        plain = docs.select("doc_id", text.alias("text"), *(c.alias(f"may_{k}") for k, c in may.items()))
        has = {k: F.col("text").rlike(p) for k, p in PATTERNS.items()}
        account = F.col("may_login") & has["login"] & has["endpoint"]
        marked = plain.select("*", account.alias("account"), (F.col("may_access") & has["access"]).alias("access"))
        wanted = {"assign": F.col("may_assign"), "access": F.col("access"), "hex": has["hex"]}
        wanted |= {"secret": F.col("access"), **dict.fromkeys(("pass", "login", "endpoint"), F.col("account"))}
        wanted["blank"] = F.col("access") | F.col("account")
        columns = []
        for kind, on in wanted.items():
            for name, c in zip(("gap", "size", "good"), _hits(F.col("text"), kind), strict=True):
                columns.append(F.when(on, c).alias(f"{kind}_{name}"))
        wide = marked.select("doc_id", F.length("text").alias("n_chars"), *columns)
        hits = [_listed(i, kind) for i, kind in enumerate(wanted)]
        rows = wide.select(F.monotonically_increasing_id().alias("uid"), "doc_id", "n_chars", F.flatten(F.array_compact(F.array(*hits))).alias("hits"))
        rows = rows.withColumn("hits", F.filter("hits", lambda h: h["size"].isNotNull()))
        self.rows = materialize(rows, "secret-rows")
        each = self.rows.where(F.size("hits") > 0).select("uid", F.inline("hits"))
        before = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("uid", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        spans = each.select("uid", "kind", "good", before.cast("long").alias("end"), "size").where("good")
        self.spans = materialize(spans.select("uid", "kind", (F.col("end") - F.col("size")).alias("start"), "end"), "secret-spans")

    def scoped(self) -> DataFrame:
        """Parts of credentials with the start of the scope they lie in: uid, kind, start, end, scope."""
        blanks = self.spans.where(F.col("kind") == len(KINDS)).select("uid", "start", "end")
        # only texts with a weak part can hold a credential to be linked
        weak = F.exists("hits", lambda h: (h["kind"] >= len(STRONG)) & (h["kind"] < len(KINDS)))
        sized = self.rows.where(weak).select("uid", "n_chars")
        blanks = blanks.unionAll(sized.select("uid", F.lit(-1).cast("long"), F.lit(0).cast("long")))
        until = F.lead("start").over(Window.partitionBy("uid").orderBy("start"))
        scopes = blanks.select("uid", F.col("end").alias("scope"), until.alias("until")).join(sized, "uid")  # texts without a weak part drop out
        until = F.coalesce("until", F.col("n_chars") + 1)
        last = F.floor(until / REACH)
        scopes = scopes.select("uid", "scope", until.alias("until"), F.explode(F.sequence(F.floor(F.col("scope") / REACH), last)).alias("bucket"))
        parts = self.spans.where(F.col("kind") < len(KINDS)).withColumn("bucket", F.floor(F.col("start") / REACH))
        found = parts.join(scopes, ["uid", "bucket"]).where("scope <= start AND start < until")
        return found.select("uid", "kind", "start", "end", "scope")

    def links(self) -> DataFrame:
        """Credentials: uid, credential, kind, start, end of the anchor, and parts (nearest of each role)."""
        parts = materialize(self.scoped(), "secret-parts")
        index = {k: i for i, k in enumerate(KINDS)}
        roles = parts.select(
            "uid", "scope", F.floor(F.col("start") / REACH).alias("bucket"),
            F.struct("kind", "start", "end").alias("part"),
        )
        found = None
        for name, (anchors, needed) in CREDENTIALS.items():
            own = parts.where(F.col("kind").isin([index[k] for k in anchors]))
            near = F.floor(F.col("start") / REACH)
            own = own.withColumn("bucket", F.explode(F.array(near - 1, near, near + 1)))
            met = own.join(roles.where(F.col("part.kind").isin([index[k] for k in needed])), ["uid", "scope", "bucket"])
            far = F.abs(F.col("part.start") - F.col("start"))
            met = met.where(far <= REACH)
            nearest = met.groupBy("uid", "kind", "start", "end", F.col("part.kind").alias("role")).agg(F.min(F.struct(far.alias("far"), "part")).alias("best"))
            whole = nearest.groupBy("uid", "kind", "start", "end").agg(F.array_sort(F.collect_list("best.part")).alias("parts"))
            whole = whole.where(F.size("parts") == len(needed)).withColumn("credential", F.lit(name))
            found = whole if found is None else found.unionByName(whole)
        return found.select("uid", "credential", "kind", "start", "end", "parts")

    def report(self) -> DataFrame:
        """Per document row: doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
        strong = self.spans.where(F.col("kind") < len(STRONG))
        links = self.links()
        linked = links.select("uid", F.inline(F.concat(F.array(F.struct("kind", "start", "end")), "parts")))
        linked = linked.where(F.col("kind") >= len(STRONG)).distinct()
        own = strong.unionByName(linked).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("own"))
        names = F.array(*map(F.lit, KINDS))

        def joined(spans: Column) -> Column:
            return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

        base = F.filter("own", lambda s: s["kind"] < len(STRONG))

        def count(index: int) -> Column:
            return F.size(F.filter("own", lambda s: s["kind"] == index)).cast("long")

        counts = [count(i).alias(f"n_{k}") for i, k in enumerate(STRONG)]
        found = own.select("uid", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("own")).alias("spans"))
        none = [F.lit(0).cast("long").alias(f"n_{k}") for k in STRONG] + [F.sha2(F.lit(""), 256).alias("base_sha256"), F.lit("").alias("spans")]
        # only rows with a match take part in the join
        plain = self.rows.where(F.size("hits") == 0).select("doc_id", *none)
        rows = self.rows.where(F.size("hits") > 0).select("uid", "doc_id").join(found, "uid", "left")
        filled = [F.coalesce(c, n).alias(c) for c, n in zip(("n_assign", "n_access", "n_hex", "base_sha256", "spans"), none, strict=True)]
        return plain.unionAll(rows.select("doc_id", *filled))


def _oracle() -> str:
    """DuckDB SQL of the report, with comparisons of all parts of a scope instead of buckets."""
    quoted = {k: p.replace("'", "''") for k, p in (PATTERNS | {"blank": BLANK}).items()}
    kinds = " UNION ALL ".join(
        f"SELECT uid, {i} AS kind, list_transform(regexp_split_to_array(text, '{p}'), lambda x: length(x)) AS gaps, "
        f"regexp_extract_all(text, '{p}', 0) AS found, regexp_extract_all(text, '{p}', {2 if k == 'assign' else 0}) AS vals FROM d"
        for i, (k, p) in enumerate(quoted.items())
    )
    index = {k: i for i, k in enumerate(KINDS)}
    links = []
    for anchors, needed in CREDENTIALS.values():
        near = [
            f"(SELECT min((abs(p.start - a.start), p.kind, p.start, p.stop)) FROM parts p WHERE p.uid = a.uid AND p.scope = a.scope AND p.kind = {index[r]} AND abs(p.start - a.start) <= {REACH})"
            for r in needed
        ]
        links.append(
            f"SELECT uid, kind, start, stop, {', '.join(f'{n} AS r{i}' for i, n in enumerate(near))}"
            f"{', NULL AS r1' if len(near) == 1 else ''}, {len(near)} AS needed FROM parts a WHERE kind IN ({', '.join(str(index[k]) for k in anchors)})"
        )
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    named = f"{names}[kind + 1] || ':' || start || ':' || stop"
    return f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({kinds}),
each AS (SELECT uid, kind, unnest(range(1, len(found) + 1)) AS pos, unnest(found) AS m, unnest(vals) AS val, unnest(gaps[:len(found)]) AS gap FROM hits),
spans AS (
  SELECT uid, kind, m, val, sum(gap + length(m)) OVER (PARTITION BY uid, kind ORDER BY pos) AS stop, stop - length(m) AS start FROM each),
good AS (
  SELECT uid, kind, start::BIGINT AS start, stop::BIGINT AS stop FROM spans
  WHERE CASE kind WHEN 0 THEN length(val) >= {ASSIGN_VALUE}
    WHEN 3 THEN length(m) = {SECRET_SIZE} AND regexp_matches(m, '[a-z]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[0-9]') ELSE true END),
parts AS (
  SELECT *, coalesce((SELECT max(b.stop) FROM good b WHERE b.uid = g.uid AND b.kind = {len(KINDS)} AND b.stop <= g.start), 0) AS scope
  FROM good g WHERE kind < {len(KINDS)}),
links AS ({" UNION ALL ".join(links)}),
whole AS (SELECT * FROM links WHERE r0 IS NOT NULL AND (needed = 1 OR r1 IS NOT NULL)),
weak AS (
  SELECT uid, kind, start, stop FROM whole UNION SELECT uid, r0[2], r0[3], r0[4] FROM whole
  UNION SELECT uid, r1[2], r1[3], r1[4] FROM whole WHERE r1 IS NOT NULL),
listed AS (
  SELECT uid, kind, start, stop FROM good WHERE kind < {len(STRONG)} UNION ALL SELECT * FROM weak WHERE kind >= {len(STRONG)}),
report AS (
  SELECT uid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg({named}, ',' ORDER BY start, kind, stop) FILTER (kind < {len(STRONG)}) AS base, string_agg({named}, ',' ORDER BY start, kind, stop) AS spans
  FROM listed GROUP BY uid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN report USING (uid)"""


ORACLE = _oracle()
