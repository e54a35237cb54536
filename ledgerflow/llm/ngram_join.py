"""N-gram Jaccard join: T-occurrence search with DivideSkip over inverted lists.

Two documents link when the Jaccard similarity of their sets of distinct
five-word shingles is at least 0.8. Equal sets are one node from the start, so
copies never meet in pairs. The steps, each a Spark job:

1. *Sets.* Per text: size and 64-bit digest of its sorted 64-bit shingle hashes. The same pass reports shingles that are frequent within a batch; those
   frequent over the whole corpus (at most average set size times
   :data:`FREQUENT` shingles) form the list of *long* inverted lists.
2. *Candidates.* In one global order (long lists last, else by hash) a pair with
   overlap t shares l shingles within the first n - t + l of each set. These
   prefixes meet in buckets of the hash range; shingles found in a single set
   drop out, and a node with fewer than l shared ones has no partner. Of the rest
   only the rarest, all but l - 1, are needed for a pair to meet once more. Long
   lists take no part in the exchange: their length is known already.
3. *Groups.* Nodes that meet in such a rare shingle are connected; whole
   components are packed into blocks of about :data:`BLOCK` shingles. A component
   larger than a block is cut into slices, and every pair of slices is a block,
   which keeps the search exact at any size. Texts go to their blocks only if
   their key passes a bitmap, of bounded size, of the nodes in blocks.
4. *Search.* In a block: inverted lists over all shingles. For each query set the
   L longest lists are set aside, the short ones are merged (with a heap up to
   :data:`HEAP` postings, by counting above: same result, no Python step per
   posting), sets that reach
   T - L occurrences are probed in the long ones by binary search, and those that
   reach the overlap T = ceil(4 (|x| + |y|) / 9) are links. A block returns, per
   node, its number of links and its root in the block's union of links.
5. Roots of all blocks give the components.

Defined cases: null, empty or blank texts have an empty set, link with nothing
and are their own component; a text of one to four words is one shingle; a null
doc_id takes part with its text, and its component is the smallest non-null id
(null if there is none); repeated rows are copies; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from hashlib import blake2b
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import frames, materialize, packed, text_words
from .graph import components

WORDS = 5
#: Shingles found in more than one of FREQUENT documents count as long lists.
FREQUENT = 500
#: l as a percentage of a set's size: larger prefixes, fewer nodes without a partner.
SPARE_PCT = 6
#: Shingles of a block, and postings of a bucket of the exchange.
BLOCK = 400_000
BUCKET = 500_000
#: Total length of short lists up to which they are merged with a heap; longer
#: ones are merged by counting, which gives the same result.
HEAP = 2_000
#: Texts that a task turns into sets at a time.
FRAME_ROWS = 2_000
#: Side of nodes in a block that is searched against itself; 0 and 1 face each other.
ALONE = 2

U = np.uint64
STEP, MIX1, MIX2 = U(0x9E3779B97F4A7C15), U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def shingles(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text."""
    found = text_words(text)
    found = [w.lower() for w in found]  # bytes: A-Z only
    if not found:
        return np.zeros(0, dtype=np.uint64)
    each = pd.util.hash_array(np.array(found, dtype=object), categorize=False)
    n = max(1, len(each) - words + 1)
    k = min(words, len(each))
    out = np.full(n, U(k))
    for i in range(k):
        out = (out * STEP) ^ each[i : i + n]
        out ^= out >> U(29)
    out = (out ^ (out >> U(30))) * MIX1
    out = (out ^ (out >> U(27))) * MIX2
    return np.unique(out ^ (out >> U(31)))


def set_id(tokens: np.ndarray) -> int:
    return int.from_bytes(blake2b(tokens.tobytes(), digest_size=8).digest(), "big", signed=True)


def least_overlap(n: np.ndarray | int) -> np.ndarray | int:
    """Overlap that a set of n needs with any partner: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def spare(n: np.ndarray | int) -> np.ndarray | int:
    """l: how many shingles of the prefixes a pair must share."""
    return (SPARE_PCT * n + 99) // 100


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (doc_id, sid, n, tkey) of documents; rows (token, seen) of shingles frequent in the batch."""
    for batch in frames(batches, FRAME_ROWS):
        own, ids, sizes, at = [], [], [], {}
        for text in batch["text"]:
            tokens = shingles(text)
            sid = set_id(tokens)
            ids.append(sid)
            sizes.append(len(tokens))
            if sid not in at and len(tokens):
                at[sid] = True
                own.append(tokens)
        yield pd.DataFrame({"doc_id": batch["doc_id"], "sid": ids, "n": sizes, "tkey": batch["tkey"], "token": None, "seen": None}).astype({"token": "Int64", "seen": "Int64"})
        if own:
            token, seen = np.unique(np.concatenate(own), return_counts=True)
            much = seen >= max(8, len(batch) // FREQUENT)
            if much.any():
                yield pd.DataFrame({"doc_id": None, "sid": None, "n": None, "tkey": None, "token": token[much].view(np.int64), "seen": seen[much]}).astype({"doc_id": "Int64", "sid": "Int64", "n": "Int64", "tkey": "Int64"})


def _prefixes(long: np.ndarray, seen: np.ndarray, buckets: int):
    """Prefix postings of each batch: (bucket, payload) for short lists, (sid, token, df) for long ones."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in frames(batches, FRAME_ROWS):
            known, toks, sids, far, far_sid = set(), [], [], [], []
            for text in batch["text"]:
                tokens = shingles(text)
                n = len(tokens)
                sid = set_id(tokens)
                if not n or sid in known:
                    continue
                known.add(sid)
                keep = n - least_overlap(n) + spare(n)
                if len(long):
                    pos = np.minimum(np.searchsorted(long, tokens), len(long) - 1)
                    is_long = long[pos] == tokens
                    short, rest = tokens[~is_long][:keep], pos[is_long]
                    if (more := keep - len(short)) > 0 and len(rest):
                        rest = rest[np.lexsort((rest, seen[rest]))][:more]
                        far.append(rest)
                        far_sid.append(np.full(len(rest), sid, dtype=np.int64))
                else:
                    short = tokens[:keep]
                toks.append(short)
                sids.append(np.full(len(short), sid, dtype=np.int64))
            if sum(map(len, toks)):
                token, sid = np.concatenate(toks), np.concatenate(sids)
                bucket = ((token >> U(32)) * U(buckets) >> U(32)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                token, sid, bucket = token[order], sid[order], bucket[order]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=buckets + 1))
                yield pd.DataFrame({
                    "bucket": bucket[cuts[:-1]],
                    "payload": [token[a:b].tobytes() + sid[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
                    "sid": None, "token": None, "df": None,
                }).astype({"sid": "Int64", "token": "Int64", "df": "Int64"})
            if far:
                rest = np.concatenate(far)
                yield pd.DataFrame({
                    "bucket": None, "payload": None, "sid": np.concatenate(far_sid),
                    "token": long[rest].view(np.int64), "df": seen[rest],
                }).astype({"bucket": "Int64"})

    return run


def _shared(rows: pd.DataFrame) -> pd.DataFrame:
    """(sid, token, df) of the bucket's shingles that two or more sets have."""
    parts = [np.frombuffer(p, dtype=np.uint64) for p in rows["payload"]]
    token = np.concatenate([p[: len(p) // 2] for p in parts])
    sid = np.concatenate([p[len(p) // 2 :] for p in parts]).view(np.int64)
    order = np.lexsort((sid, token))
    token, sid = token[order], sid[order]
    first = np.ones(len(token), dtype=bool)
    first[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid = token[first], sid[first]
    _, back, df = np.unique(token, return_inverse=True, return_counts=True)
    keep = df[back] > 1
    return pd.DataFrame({"sid": sid[keep], "token": token[keep].view(np.int64), "df": df[back][keep]})


def occurrences(lists: list[np.ndarray], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted id lists: the ids and how many lists hold each."""
    if sum(map(len, lists)) <= HEAP:
        merged = [(k, sum(1 for _ in g)) for k, g in groupby(heapq.merge(*(x.tolist() for x in lists)))]
        return np.array([k for k, _ in merged], dtype=np.int64), np.array([c for _, c in merged], dtype=np.int64)
    counts = np.bincount(np.concatenate(lists), minlength=size)
    ids = np.flatnonzero(counts)
    return ids, counts[ids]


def divide_skip(sets: list[np.ndarray], queries: np.ndarray, index: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each query set, the positions of index sets that link with it.

    ``queries`` and ``index`` hold positions in ``sets``; where a pair could be
    found from both sides, it is given once, at the later position.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    owner = np.repeat(index, sizes[index])
    tokens = np.concatenate([sets[i] for i in index]) if len(index) else np.zeros(0, np.uint64)
    order = np.lexsort((owner, tokens))
    owner, tokens = owner[order], tokens[order]
    names, starts, lens = np.unique(tokens, return_index=True, return_counts=True)
    within = np.zeros(len(sets), dtype=bool)
    within[index] = True
    for x in queries.tolist():
        n = len(sets[x])
        if not n or not len(names):
            continue
        pos = np.minimum(np.searchsorted(names, sets[x]), len(names) - 1)
        pos = pos[(names[pos] == sets[x]) & (lens[pos] > (1 if within[x] else 0))]
        least = int(least_overlap(n))
        if len(pos) < least:
            continue
        pos = pos[np.argsort(lens[pos], kind="stable")]
        longest = int(lens[pos[-1]])
        n_long = min(least - 1, int(least / (0.02 * np.log2(longest + 1) + 1)))
        lists = [owner[starts[p] : starts[p] + lens[p]] for p in pos]
        ids, seen = occurrences(lists[: len(lists) - n_long], len(sets))
        fit = (seen >= least - n_long) & (5 * sizes[ids] >= 4 * n) & (4 * sizes[ids] <= 5 * n)
        fit &= (ids < x) | ~within[x]
        ids, seen = ids[fit], seen[fit]
        need = -(-4 * (n + sizes[ids]) // 9)
        for left, probe in zip(range(n_long, 0, -1), lists[len(lists) - n_long :], strict=True):
            able = seen + left >= need
            if not able.all():
                ids, seen, need = ids[able], seen[able], need[able]
            if not len(ids):
                break
            at = np.minimum(np.searchsorted(probe, ids), len(probe) - 1)
            seen = seen + (probe[at] == ids)
        ids = ids[seen >= need]
        if len(ids):
            yield x, ids


def _search(rows: pd.DataFrame) -> pd.DataFrame:
    """Links of a block: per node its number of linked documents here and its root."""
    rows = rows.drop_duplicates(["sid", "side"]).sort_values(["n", "sid"], kind="stable").reset_index(drop=True)
    sets = [shingles(t) for t in rows["text"]]
    copies, sids, side = rows["copies"].to_numpy(), rows["sid"].to_numpy(), rows["side"].to_numpy()
    every = np.arange(len(sets))
    queries, index = (every, every) if (side == ALONE).all() else (every[side == 0], every[side == 1])
    links, parent = np.zeros(len(sets), dtype=np.int64), list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x, found in divide_skip(sets, queries, index):
        links[x] += copies[found].sum()
        links[found] += copies[x]
        a = root(x)
        for y in found.tolist():
            b = root(y)
            if a != b:
                a, b = (a, b) if sids[a] < sids[b] else (b, a)
                parent[b] = a
    hit = np.flatnonzero(links)
    return pd.DataFrame({"sid": sids[hit], "links": links[hit], "root": sids[[root(i) for i in hit.tolist()]]}).astype("int64")


def _classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, tkey, sid, n, root (null for an empty set), component_id, n_links."""
    source = docs.select("doc_id", "text", F.xxhash64("text").alias("tkey"))
    row_key = F.xxhash64("doc_id", "tkey")
    every = materialize(source.mapInPandas(_sets, "doc_id long, sid long, n long, tkey long, token long, seen long"), "sets")
    sets = every.where("sid IS NOT NULL").select("doc_id", "sid", "n", "tkey")
    nodes = sets.where("n > 0").groupBy("sid").agg(
        F.max("n").alias("n"), F.count("*").alias("copies"), F.min("doc_id").alias("least_doc"),
        F.min(F.struct("doc_id", "tkey")).alias("rep"),
    )
    nodes = materialize(nodes, "nodes")
    n_docs, total = nodes.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()

    frequent = (
        every.where("token IS NOT NULL").groupBy("token").agg(F.sum("seen").alias("seen"))
        .where(F.col("seen") >= F.lit(max(16, n_docs // FREQUENT)))
    )
    frequent = frequent.toPandas()  # at most total / (n_docs / FREQUENT) rows, see the docstring
    long = frequent["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(long)
    long, seen = long[order], frequent["seen"].to_numpy(dtype=np.int64)[order]
    buckets = max(16, total // 4 // BUCKET)
    prefixes = docs.select("text").mapInPandas(
        _prefixes(long, seen, buckets), "bucket long, payload binary, sid long, token long, df long"
    )
    prefixes = materialize(prefixes, "prefixes")
    short = (
        prefixes.where("bucket IS NOT NULL").select("bucket", "payload")
        .groupBy("bucket").applyInPandas(_shared, "sid long, token long, df long")
    )
    far = prefixes.where("token IS NOT NULL").select("sid", "token", "df").distinct()
    by_node = Window.partitionBy("sid")
    shared = (
        short.union(far).join(nodes.select("sid", "n"), "sid")
        .select("sid", "token", "n", F.count("*").over(by_node).alias("s"), F.row_number().over(by_node.orderBy("df", "token")).alias("r"))
    )
    least_partner = F.expr("(4 * n + 4) div 5")
    kept = shared.where(F.col("r") <= F.col("s") - F.floor((SPARE_PCT * least_partner + 99) / 100) + 1)
    kept = materialize(kept.select("sid", "token"), "kept")
    hubs = kept.groupBy("token").agg(F.min("sid").alias("hub"), F.count("*").alias("m")).where("m > 1")
    edges = kept.join(hubs, "token").where("sid <> hub").select(F.col("sid").alias("a"), F.col("hub").alias("b")).distinct()
    groups = components(edges)

    members = groups.select(F.col("node").alias("sid"), F.col("label").alias("grp")).join(nodes, "sid")
    members = materialize(members.select("sid", "grp", "n", "copies", "rep"), "members")
    load = members.groupBy("grp").agg(F.sum("n").alias("tokens"))
    blocks = max(1, -(-(members.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // BLOCK))
    slices = F.ceil(F.col("tokens") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("sid"), F.col("m")).cast("int")
    placed = members.join(load.withColumn("m", slices).select("grp", "m"), "grp").withColumn("i", own)
    placed = placed.withColumn("j", F.explode(F.expr("sequence(0, m - 1)"))).select(
        "sid", "n", "copies", "rep",
        F.when(F.col("m") == 1, F.pmod(F.xxhash64("grp"), F.lit(blocks))).otherwise(
            F.xxhash64("grp", F.least("i", "j"), F.greatest("i", "j"))
        ).alias("block"),
        F.when(F.col("i") == F.col("j"), ALONE).otherwise((F.col("i") > F.col("j")).cast("int")).alias("side"),
    )
    bitmap = key_filter(members.select("rep.*").select(row_key), members.count())
    # nodes in blocks grow with the corpus: not a side to broadcast, at any size
    texts = source.where(maybe_in(bitmap)(row_key)).join(
        placed.select("rep.*", "sid", "n", "copies", "block", "side").withColumnRenamed("doc_id", "rep_id")
        .withColumnRenamed("tkey", "rep_key").hint("merge"),
        F.col("doc_id").eqNullSafe(F.col("rep_id")) & (F.col("tkey") == F.col("rep_key")),
    )
    found = (
        texts.select("block", "side", "sid", "n", "copies", "text")
        .groupBy("block").applyInPandas(_search, "sid long, links long, root long")
    )
    found = materialize(found, "links")
    roots = components(found.select(F.col("sid").alias("a"), F.col("root").alias("b")))
    linked = (
        found.groupBy("sid").agg(F.sum("links").alias("links"))
        .join(roots.select(F.col("node").alias("sid"), F.col("label").alias("root")), "sid", "left")
    )
    classes = nodes.select("sid", "copies", "least_doc").join(linked, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    least = classes.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    classes = classes.join(least, "root").select(
        "sid", "root", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return sets.join(classes, "sid", "left")


def key_filter(keys: DataFrame, n_keys: int) -> np.ndarray:
    """Bitmap of the keys (a column of longs): a bounded summary with false positives only.

    Its bits are 16 a key, rounded up to a power of two, between 2^20 and 2^28
    (32 MB); beyond that it lets more keys through, never fewer. The bits of each
    partition are sent in pieces and joined by piece.
    """
    bits = 1 << min(28, max(20, int(np.ceil(np.log2(16 * max(1, n_keys))))))
    piece = 1 << 15

    def mark(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            at = np.unique(batch.iloc[:, 0].to_numpy().view(np.uint64) % U(bits)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(at // piece, prepend=-1, append=-2))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield pd.DataFrame({"piece": [at[a] // piece], "bits": [(at[a:b] % piece).astype(np.uint16).tobytes()]})

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        on = np.zeros(piece, dtype=bool)
        for b in rows["bits"]:
            on[np.frombuffer(b, dtype=np.uint16)] = True
        return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "bits": [np.packbits(on).tobytes()]})

    found = keys.mapInPandas(mark, "piece long, bits binary").groupBy("piece").applyInPandas(merge, "piece long, bits binary")
    out = np.zeros(bits // 8, dtype=np.uint8)
    for p, b in found.toPandas().itertuples(index=False):
        out[p * piece // 8 : (p + 1) * piece // 8] = np.frombuffer(b, dtype=np.uint8)
    return out


def maybe_in(bitmap: np.ndarray):
    """Column function: may this key be among the bitmap's?"""

    @pandas_udf("boolean")
    def test(key: pd.Series) -> pd.Series:
        at = key.to_numpy().view(np.uint64) % U(8 * len(bitmap))
        return pd.Series((bitmap[(at >> U(3)).astype(np.int64)] >> (U(7) - (at & U(7))).astype(np.uint8)) & 1 > 0)

    return test


def join(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, n_links, set_id.

    ``n_links`` counts the linked documents, copies included; documents with the
    same ``set_id`` have equal shingle sets.
    """
    return _classes(docs).select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.col("sid").alias("set_id"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, with its own columns: the one with the smallest doc_id.

    An id is smaller than no id, ties go to the smaller text hash, and of repeated
    rows one stays. Texts without a word are in no group and all stay.
    """
    found = materialize(_classes(docs).select("doc_id", "tkey", "root"), "classes")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tkey")).alias("first")
    chosen = found.where("root IS NOT NULL").groupBy("root").agg(first).select("first.doc_id", "first.tkey")
    again = found.groupBy("doc_id", "tkey").agg(F.max("root").isNull().alias("empty"), (F.count("*") > 1).alias("again"))
    same = again["doc_id"].eqNullSafe(chosen["doc_id"]) & (again["tkey"] == chosen["tkey"])
    kept = again.where("empty").select("doc_id", "tkey", F.lit(False).alias("again")).union(
        again.where("NOT empty").join(chosen, same, "left_semi").select("doc_id", "tkey", "again")
    )
    rows = packed(docs)
    rows = rows.join(kept, rows["id"].eqNullSafe(kept["doc_id"]) & (rows["key"] == kept["tkey"])).select("row", "id", "key", "again")
    return rows.where("NOT again").unionByName(rows.where("again").dropDuplicates(["id", "key"])).select("row.*")
