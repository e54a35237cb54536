"""Conversation prefix trie with totals rolled up by centroid decomposition.

1. *Turns.* Turns are dealt by range of (conversation, turn, role, digest), so a
   conversation of any length is spread over many tasks. Each task numbers its part
   and forms a prefix hash modulo :data:`PRIME` (127 bits); hashes of parts join
   (``hash(xy) = hash(x) * BASE**len(y) + hash(y)``), so number and hash of the turns
   before come from one row per task and conversation that crosses a task border.
2. *Nodes.* A rebuilt conversation is a head of another and a tail of its own; the
   hash of each of its prefixes is that of its own prefix plus a shift. Equal prefixes
   meet in a grouped sum: one node of the trie per depth and hash.
3. *Rollup.* The parent edges below the root form a forest. A component's weight is
   its rows (with copies), known for every node from the grouping; its centroid is the
   deepest node that holds half of it or more. The nodes that do lie on the path from
   the component's top, so the path is a filter. The centroid leaves, its children
   become tops, totals are summed per component, the total at and below the centroid
   is added to the path above it, and the path's weights shrink. Weights halve, so a
   node takes part in a logarithmic number of rounds.
   Components of more than :data:`COMPONENT` rows are split by joins over the cluster
   (an ancestor at a depth is looked up in the rows of the node's smallest member);
   smaller ones are dealt to tasks and split there, many at a time.
4. *Ends.* Ids that end in a node are sorted by range, written out in chunks by all
   tasks, and the chunks of a node hashed in order as a stream.

Defined cases: rows without conv_id belong to no conversation; turns of equal number
are ordered by role and digest of role and text; repeated rows are turns each;
negative ids take the remainder towards zero; a table without conversations gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import LongType, StructField, StructType

from .common import WORD_PATTERN, materialize
from .permuterm import CRC_TABLE, crc_sql

#: Fixed values of the contract: conversations that share a head, and the bound of its turns.
FAMILY, HEADS = 20, 4
PRIME, BASE = 2**127 - 1, 0x5DEECE66D1234567890ABCDEF1357
#: Rows of a component that a task may split, and rows dealt to a task group.
COMPONENT, BUCKET = 1 << 12, 1 << 10
KEY, PARENT, PART = ["depth", "hi", "lo"], ["p_hi", "p_lo"], ["c_depth", "c_hi", "c_lo"]

HASH = StructType([StructField("hi", LongType()), StructField("lo", LongType())])


def _join(hi: int, lo: int) -> int:
    return (int(hi) << 64) | (int(lo) & 0xFFFFFFFFFFFFFFFF)


def _cut(x: int) -> tuple[int, int]:
    lo = x & 0xFFFFFFFFFFFFFFFF
    return x >> 64, lo - (1 << 64) if lo >> 63 else lo


@pandas_udf(HASH)
def shifted(hi: pd.Series, lo: pd.Series, d_hi: pd.Series, d_lo: pd.Series, k: pd.Series) -> pd.DataFrame:
    """(hi, lo) + (d_hi, d_lo) * BASE**k: the hash of k elements behind another beginning."""
    out = [
        (a, b) if not (c or d) else _cut((_join(a, b) + _join(c, d) * pow(BASE, int(n), PRIME)) % PRIME)
        for a, b, c, d, n in zip(hi, lo, d_hi, d_lo, k, strict=True)
    ]
    return pd.DataFrame(out, columns=["hi", "lo"], dtype="int64")


@pandas_udf(HASH)
def minus(hi: pd.Series, lo: pd.Series, o_hi: pd.Series, o_lo: pd.Series) -> pd.DataFrame:
    out = [_cut((_join(a, b) - _join(c, d)) % PRIME) for a, b, c, d in zip(hi, lo, o_hi, o_lo, strict=True)]
    return pd.DataFrame(out, columns=["hi", "lo"], dtype="int64")


def _number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Number and prefix hash of turns within a task's part of each conversation."""
    conv, at, h = None, 0, 0
    for b in batches:
        out = []
        for c, pid, digest, words in zip(b["conv_id"], b["pid"], b["digest"], b["words"], strict=True):
            if c != conv:
                conv, at, h = c, 0, 0
            before = _cut(h)
            h = (h * BASE + 1 + int.from_bytes(digest, "big")) % PRIME
            out.append((c, pid, at, *_cut(h), *before, words))
            at += 1
        yield pd.DataFrame(out, columns=["conv_id", "pid", "at", "hi", "lo", "b_hi", "b_lo", "words"])


def _borders(df: pd.DataFrame) -> pd.DataFrame:
    """Turns and hash before each part of one conversation (a row per task that holds some of it)."""
    at, h, out = 0, 0, []
    for r in df.sort_values("pid").itertuples():
        out.append((r.conv_id, r.pid, at, *_cut(h)))
        at += r.n
        h = (h * pow(BASE, r.n, PRIME) + _join(r.hi, r.lo)) % PRIME
    return pd.DataFrame(out, columns=["conv_id", "pid", "skipped", "s_hi", "s_lo"])


def number_turns(conversations: DataFrame) -> DataFrame:
    """Turns in order: conv_id, at (from 0), hi, lo (hash up to the turn), b_hi, b_lo (hash before it), words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"), F.unhex(F.substring(F.sha2(named.cast("binary"), 256), 1, 30)).alias("digest"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
    )
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    dealt = materialize(turns, "trie-hashed").repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("conv_id", F.spark_partition_id().alias("pid"), "digest", "words")
    local = materialize(
        dealt.mapInPandas(_number, "conv_id long, pid int, at long, hi long, lo long, b_hi long, b_lo long, words long"), "trie-local"
    )
    parts = local.groupBy("conv_id", "pid").agg(F.count("*").alias("n"), F.max_by(F.struct("hi", "lo"), "at").alias("all"))
    torn = parts.groupBy("conv_id").agg(F.count("*").alias("parts")).where("parts > 1").select("conv_id")
    borders = parts.select("conv_id", "pid", "n", "all.hi", "all.lo").join(torn, "conv_id")
    borders = borders.groupBy("conv_id").applyInPandas(_borders, "conv_id long, pid int, skipped long, s_hi long, s_lo long")
    borders = materialize(borders, "trie-borders")
    # at most two rows per task: the conversation at its beginning and the one at its end
    turns = local.join(F.broadcast(borders), ["conv_id", "pid"], "left")
    s = [F.coalesce(c, F.lit(0)) for c in ("s_hi", "s_lo")]
    turns = turns.withColumn("own", shifted("hi", "lo", *s, F.col("at") + 1)).withColumn("before", shifted("b_hi", "b_lo", *s, F.col("at")))
    at = (F.col("at") + F.coalesce("skipped", F.lit(0))).alias("at")
    return materialize(turns.select("conv_id", at, "own.hi", "own.lo", F.col("before.hi").alias("b_hi"), F.col("before.lo").alias("b_lo"), "words"), "trie-turns")


def rebuild(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations (conv_id, len) and their rows.

    A row per conversation and turn: conv_id, len, f_hi, f_lo (hash of the first turn),
    depth, hi, lo (hash up to the turn), p_hi, p_lo (before it), words of the turn.
    """
    first = F.when(F.col("at") < HEADS, F.struct("at", "hi", "lo", "words"))
    convs = turns.groupBy("conv_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(first)).alias("heads"))
    convs = materialize(convs, "trie-convs")
    base = convs.select(F.col("conv_id").alias("base_id"), F.col("n").alias("base_n"), F.col("heads").alias("base"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("h")
    both = convs.select("*", h, (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base_id")).join(base, "base_id", "left")
    both = both.withColumn("m", F.least("h", F.coalesce("base_n", F.lit(0))))

    def part(array: str, count: Column, name: str) -> Column:
        """Half ``name`` of the hash of the first ``count`` turns."""
        return F.when(count > 0, F.get(array, (count - 1).cast("int"))[name]).otherwise(F.lit(0))

    own = F.least("h", "n")
    delta = minus(*(part("base", F.col("m"), c) for c in ("hi", "lo")), *(part("heads", own, c) for c in ("hi", "lo")))
    both = both.withColumn("delta", delta).withColumn("len", F.col("m") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    start = F.get("heads", F.col("h").cast("int"))
    moved = shifted(F.coalesce(start["hi"], F.lit(0)), F.coalesce(start["lo"], F.lit(0)), "delta.hi", "delta.lo", F.lit(1))
    both = both.withColumn("moved", moved)
    firsts = [F.when(F.col("m") > 0, F.get("base", F.lit(0))[c]).otherwise(F.col(f"moved.{c}")).alias(f"f_{c}") for c in ("hi", "lo")]
    both = materialize(both.select("conv_id", "h", "m", "len", F.col("delta.hi").alias("d_hi"), F.col("delta.lo").alias("d_lo"), *firsts, F.slice("base", F.lit(1), F.col("m").cast("int")).alias("head")), "trie-rebuilt")

    each = both.where("m > 0").select("conv_id", "len", "f_hi", "f_lo", "head", F.posexplode("head").alias("pos", "turn"))
    prev = [F.when(F.col("pos") > 0, F.get("head", F.col("pos") - 1)[c]).otherwise(F.lit(0)).alias(f"p_{c}") for c in ("hi", "lo")]
    heads = each.select("conv_id", "len", "f_hi", "f_lo", (F.col("pos") + 1).cast("long").alias("depth"), "turn.hi", "turn.lo", *prev, "turn.words")
    tails = turns.join(both.select("conv_id", "h", "m", "len", "d_hi", "d_lo", "f_hi", "f_lo"), "conv_id").where("at >= h")
    k = F.col("at") - F.col("h")
    tails = tails.withColumn("own", shifted("hi", "lo", "d_hi", "d_lo", k + 1)).withColumn("prev", shifted("b_hi", "b_lo", "d_hi", "d_lo", k))
    tails = tails.select(
        "conv_id", "len", "f_hi", "f_lo", (F.col("m") + k + 1).alias("depth"), "own.hi", "own.lo",
        F.col("prev.hi").alias("p_hi"), F.col("prev.lo").alias("p_lo"), "words",
    )
    return both.select("conv_id", "len"), materialize(heads.unionByName(tails), "trie-rows")


def _split(df: pd.DataFrame) -> pd.DataFrame:
    """Totals at and below each node for whole components, by centroid decomposition of all of them at once."""
    n = len(df)
    names = {k: i for i, k in enumerate(zip(*(df[c] for c in KEY), strict=True))}
    tops = set(zip(*(df[c] for c in PART), strict=True))
    depth, weight = df["depth"].to_numpy(), df["weight"].to_numpy().copy()
    parent = np.array([-1 if k in tops else names[k[0] - 1, p, q] for k, p, q in zip(names, df["p_hi"], df["p_lo"], strict=True)], dtype=np.int64)
    top = np.array([names[k] for k in zip(*(df[c] for c in PART), strict=True)], dtype=np.int64)
    own, total = df[["leaves", "saved"]].to_numpy(np.int64), df[["acc_leaves", "acc_saved"]].to_numpy(np.int64).copy()
    live = np.arange(n)
    while len(live):
        path = live[2 * weight[live] >= weight[top[live]]]
        path = path[np.lexsort((depth[path], top[path]))]
        centre = np.full(n, -1)
        centre[top[path]] = path  # the deepest is assigned last
        mine = centre[top[live]]
        # new top of each node: jump to the parent until a top, a centroid or its child
        to = np.arange(n)
        free = (live != mine) & (top[live] != live) & (parent[live] != mine)
        to[live[free]] = parent[live[free]]
        while not np.array_equal(far := to[to], to):
            to = far
        under = (live == mine) | (parent[to[live]] == mine) & (to[live] != top[live])
        sums = np.zeros((n, 2), np.int64)
        np.add.at(sums, mine[under], own[live[under]])
        at = centre[top[path]]
        total[path] += sums[at]
        above = path != at
        weight[path[above]] -= weight[at[above]]
        top[live] = to[live]
        live = live[live != mine]
    return pd.DataFrame({**{c: df[c].to_numpy() for c in KEY}, "n_leaves": total[:, 0], "saved_tokens": total[:, 1]})


def roll_up(forest: DataFrame, rows: DataFrame, component: int = COMPONENT) -> DataFrame:
    """(depth, hi, lo, n_leaves, saved_tokens): sums of leaves and saved over each node's subtree.

    ``forest`` has depth, hi, lo, p_hi, p_lo, f_hi, f_lo, conv_id, weight, leaves, saved;
    ``rows`` are those of :func:`rebuild`.
    """
    zero = F.lit(0).cast("long")
    start = forest.select(
        F.lit(1).cast("long").alias("c_depth"), F.col("f_hi").alias("c_hi"), F.col("f_lo").alias("c_lo"), *KEY, *PARENT, "conv_id",
        "weight", "leaves", "saved", zero.alias("acc_leaves"), zero.alias("acc_saved"),
    )
    state, columns = materialize(start, "trie-components"), start.columns
    small, done = [], []
    while True:
        sizes = state.groupBy(*PART).agg(F.max("weight").alias("total"))
        large = materialize(sizes.where(F.col("total") > component), "trie-large")
        if large.isEmpty():
            small.append(state)
            break
        small.append(state.join(large, PART, "left_anti"))
        own = materialize(state.join(large, PART), "trie-split")
        path = own.where("2 * weight >= total")
        centre = path.groupBy(*PART).agg(F.max(F.struct("depth", "hi", "lo", "weight")).alias("g"))
        # the ancestor one below the centroid's depth, and its parent, from the rows of the smallest member
        ancestors = rows.select(
            F.col("conv_id").alias("r_id"), F.col("depth").alias("r_depth"), F.col("hi").alias("a_hi"), F.col("lo").alias("a_lo"),
            F.col("p_hi").alias("g_hi"), F.col("p_lo").alias("g_lo"),
        )
        own = own.join(centre, PART)
        below = (F.col("r_id") == F.col("conv_id")) & (F.col("r_depth") == F.col("g.depth") + 1) & (F.col("depth") > F.col("g.depth"))
        own = own.join(ancestors, below, "left").select(
            *columns, "total", "g", "a_hi", "a_lo",
            ((F.col("depth") == F.col("g.depth")) & (F.col("hi") == F.col("g.hi")) & (F.col("lo") == F.col("g.lo"))).alias("is_centre"),
            F.coalesce((F.col("g_hi") == F.col("g.hi")) & (F.col("g_lo") == F.col("g.lo")), F.lit(False)).alias("is_below"),
        )
        own = materialize(own, "trie-split")
        sums = own.where("is_centre OR is_below").groupBy(*PART).agg(F.sum("leaves").alias("s_leaves"), F.sum("saved").alias("s_saved"))
        own = own.join(sums, PART)
        done.append(materialize(own.where("is_centre").select(
            *KEY, (F.col("acc_leaves") + F.col("s_leaves")).alias("n_leaves"), (F.col("acc_saved") + F.col("s_saved")).alias("saved_tokens")
        ), "trie-done"))
        on_path, under = F.expr("2 * weight >= total"), F.col("is_below")
        new = {
            "c_depth": F.when(under, F.col("g.depth") + 1).otherwise(F.col("c_depth")),
            "c_hi": F.when(under, F.col("a_hi")).otherwise(F.col("c_hi")), "c_lo": F.when(under, F.col("a_lo")).otherwise(F.col("c_lo")),
            "weight": F.col("weight") - F.when(on_path, F.col("g.weight")).otherwise(0),
            "acc_leaves": F.col("acc_leaves") + F.when(on_path, F.col("s_leaves")).otherwise(0),
            "acc_saved": F.col("acc_saved") + F.when(on_path, F.col("s_saved")).otherwise(0),
        }
        state = materialize(own.where("NOT is_centre").select(*(new.get(c, F.col(c)).alias(c) for c in columns)), "trie-components")
    rest = small[0]
    for df in small[1:]:
        rest = rest.unionByName(df)
    rest = materialize(rest, "trie-small")
    buckets = 1 + rest.count() // BUCKET
    dealt = rest.withColumn("bucket", F.pmod(F.xxhash64(*PART), F.lit(buckets)))
    out = dealt.groupBy("bucket").applyInPandas(_split, "depth long, hi long, lo long, n_leaves long, saved_tokens long")
    for df in done:
        out = out.unionByName(df)
    return out


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Ids of each node in a batch, comma-joined; rows are sorted by node and id."""
    for b in batches:
        keys = b[KEY].to_numpy()
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(b)] if len(b) else []
        ids = b["conv_id"].tolist()
        out = [(*keys[i].tolist(), ids[i], ",".join(map(str, ids[i:j]))) for i, j in zip(cuts, cuts[1:], strict=False)]
        yield pd.DataFrame(out, columns=[*KEY, "first", "ids"])


def _hash_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """SHA-256 of each node's chunks; rows are sorted by node and first id."""
    key, sha = None, None
    for b in batches:
        out = []
        for *now, ids in zip(*(b[c].tolist() for c in KEY), b["ids"], strict=True):
            if now != key:
                if sha is not None:
                    out.append((*key, sha.hexdigest()))
                key, sha = now, hashlib.sha256()
            else:
                sha.update(b",")
            sha.update(ids.encode())
        yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
    if sha is not None:
        yield pd.DataFrame([(*key, sha.hexdigest())], columns=[*KEY, "ends_sha256"])


def hash_ends(ends: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256) for rows (depth, hi, lo, conv_id)."""
    order = [*KEY, "conv_id"]
    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(_chunks, "depth long, hi long, lo long, first long, ids string")
    chunks = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return chunks.mapInPandas(_hash_chunks, "depth long, hi long, lo long, ends_sha256 string")


def build(conversations: DataFrame, component: int = COMPONENT) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs, rows = rebuild(number_turns(conversations))
    zero = F.lit(0).cast("long")
    nodes = rows.groupBy(*KEY).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("words").alias("words"), F.sum("len").alias("lens"),
        *(F.max(c).alias(c) for c in (*PARENT, "f_hi", "f_lo")),
    )
    root = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nodes = nodes.unionByName(root.select("*", *(zero.alias(c) for c in (*KEY, "words", "lens", *PARENT, "f_hi", "f_lo"))))
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo"))
    nodes = nodes.join(children.agg(F.count("*").alias("n_children")), KEY, "left").withColumn("n_children", F.coalesce("n_children", zero))
    nodes = materialize(nodes, "trie-nodes")
    forest = nodes.where("depth > 0").select(
        *KEY, *PARENT, "f_hi", "f_lo", "conv_id", (F.col("lens") - F.col("n_convs") * (F.col("depth") - 1)).alias("weight"),
        (F.col("n_children") == 0).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    rolled = materialize(roll_up(forest, rows, component), "trie-rolled")
    trees = rolled.where("depth = 1").agg(F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"), F.coalesce(F.sum("saved_tokens"), zero).alias("saved_tokens"))
    rolled = rolled.unionByName(trees.select(*(zero.alias(c) for c in KEY), "*"))
    # the root is the parent of every first turn: its one value needs no join
    least = root.first()
    parents = nodes.where("depth > 0").select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("conv_id").alias("parent_conv_id"))
    high = nodes.where("depth < 2").withColumn("parent_conv_id", F.when(F.col("depth") == 1, F.lit(least["conv_id"] if least else None).cast("long")))
    nodes = high.unionByName(nodes.where("depth > 1").join(parents, ["depth", *PARENT]))
    ends = rows.where("depth = len").select(*KEY, "conv_id").unionByName(convs.where("len = 0").select(*(zero.alias(c) for c in KEY), "conv_id"))
    nodes = nodes.join(rolled, KEY).join(hash_ends(ends), KEY, "left")
    sha = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", sha)


ORACLE = f"""
WITH {CRC_TABLE},
lists AS (
  SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS l
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
heads AS (SELECT conv_id, l, ({crc_sql("conv_id::VARCHAR")} % {HEADS})::INT AS h FROM lists, crc_table),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.l[:c.h], []), c.l[c.h + 1:]) AS l
  FROM heads c LEFT JOIN lists b ON b.conv_id = c.conv_id - c.conv_id % {FAMILY}),
prefixes AS (SELECT conv_id, l, unnest(range(len(l) + 1)) AS depth FROM rebuilt),
nodes AS (
  SELECT depth, l[:depth] AS p, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(l) = depth), '')) AS ends_sha256
  FROM prefixes GROUP BY ALL),
sized AS (
  SELECT *, (n_convs - 1) * CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth].text, '{WORD_PATTERN}')) END AS own,
    (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.p[:n.depth] = n.p) AS n_children
  FROM nodes n)
SELECT n.conv_id, n.depth, min(u.conv_id) AS parent_conv_id, any_value(n.n_convs) AS n_convs, any_value(n.n_children) AS n_children,
  count(*) FILTER (s.n_children = 0) AS n_leaves, sum(s.own)::BIGINT AS saved_tokens, any_value(n.ends_sha256) AS ends_sha256
FROM sized n JOIN sized s ON s.depth >= n.depth AND s.p[:n.depth] = n.p
LEFT JOIN nodes u ON u.depth = n.depth - 1 AND n.p[:u.depth] = u.p
GROUP BY n.conv_id, n.depth"""
