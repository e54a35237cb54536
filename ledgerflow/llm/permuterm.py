"""Spelling variant grouping by permuterm rotations.

Words of all texts are counted (a fixed share of them with one letter dropped, as
the contract asks). A word ``a x b`` marked with the terminator has the rotation
``b $ a x``; without its last character, the edited one, it is ``b $ a``. So

- two words that differ in one replaced character share ``b $ a``, and
- ``a b``, one deletion away, has ``b $ a`` as a whole rotation.

All rotations are sorted by that prefix. A run of equal prefixes holds at most one
whole rotation and one word per character of the alphabet (90), so a scan of the
sorted runs has bounded state. The scan emits for every member the number of its
neighbours in the run and the best of them, never the pairs. A word with a repeated
character (``aab``) drops to the same word at several places; the place after a
different character counts, the others are skipped.

Forms are followed to their last by pointer jumping. A form has at least
:data:`RATIO` times its word's count, so a chain has at most 19 words and five
jumps end it.

Defined cases: null or empty texts have no words; a null doc_id is written as an
empty string before the colon; repeated rows count each time; of near words of
equal count the smallest in code-point order is the form; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

#: Fixed values of the contract: letters, shortest word, fewest occurrences, share of edited runs, ratio of a form.
LETTERS = "A-Za-zÀ-ÿ"
SHORTEST, FEWEST, EDITED, RATIO = 7, 2, 31, 10
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MARK = "$"


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of the words with enough letters and occurrences, over all documents."""
    run = F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{SHORTEST},}}"), F.lit(0)))
    runs = docs.select("doc_id", run.alias("run")).select("doc_id", F.translate("run", UPPER, LOWER).alias("run"))
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run"))
    runs = runs.select("run", F.crc32(named.cast("binary")).alias("h"), F.length("run").alias("length"))
    at = (F.col("h") % F.col("length")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.col("length")))
    words = runs.select(F.when(F.col("h") % EDITED == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= FEWEST)


def rotations(words: DataFrame) -> DataFrame:
    """(key, x, n): each word's rotations without their last character x, and whole (x empty)."""
    length = F.length("word")
    at = words.select("word", "n", F.explode(F.sequence(F.lit(0), length)).alias("at"))
    edited = at.where(F.col("at") < length)
    head = F.concat(F.lit(MARK), F.substring("word", F.lit(1), F.col("at")))
    whole = at.select(F.concat(F.substring("word", F.col("at") + 1, length), head).alias("key"), F.lit("").alias("x"), "n")
    short = edited.select(
        F.concat(F.substring("word", F.col("at") + 2, length), head).alias("key"), F.substring("word", F.col("at") + 1, F.lit(1)).alias("x"), "n"
    )
    return whole.unionAll(short)


def _scan(key: np.ndarray, x: np.ndarray, n: np.ndarray) -> pd.DataFrame:
    """Neighbours within runs of equal keys; rows are sorted by key and x, runs are complete."""
    same = key[1:] == key[:-1]
    in_run = np.append(False, same) | np.append(same, False)
    key, x, n = key[in_run], x[in_run], n[in_run]
    run = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1 if len(key) else np.zeros(0, np.int64)
    runs, rows = int(run[-1]) + 1 if len(run) else 0, np.arange(len(key))
    parts = [k.split(MARK) for k in key]
    word = np.array([p[1] + c + p[0] for p, c in zip(parts, x, strict=True)], dtype=object)
    whole = x == ""
    # the dropped character counts as an indel only after a different one
    indel = ~whole & (np.array([k[-1] for k in key], dtype=object) != x) if len(key) else whole
    short = np.full(runs, -1)
    short[run[whole]] = rows[whole]
    n_edited, n_indel = np.bincount(run[~whole], minlength=runs), np.bincount(run[indel], minlength=runs)

    def top(mask: np.ndarray, place: int) -> np.ndarray:
        """Row of each run's largest (place 0) or second (1) row of the mask; -1 if none."""
        own = rows[mask][np.lexsort((-n[mask], run[mask]))]  # stable: ties stay in the order of x, which is the words'
        first = np.flatnonzero(np.append(True, run[own][1:] != run[own][:-1])) if len(own) else own
        size = np.diff(np.append(first, len(own)))
        out = np.full(runs, -1)
        out[run[own[first[size > place]]]] = own[first[size > place] + place]
        return out

    best, second, best_indel = top(~whole, 0), top(~whole, 1), top(indel, 0)
    other = np.where(best[run] == rows, second[run], best[run])
    other[whole] = best_indel[run[whole]]
    also = np.where(indel, short[run], -1)
    count = np.where(whole, n_indel[run], n_edited[run] - 1 + (also >= 0))
    n_other, n_also = np.where(other >= 0, n[other], 0), np.where(also >= 0, n[also], 0)
    swap = n_also > n_other
    for i in np.flatnonzero((n_also == n_other) & (also >= 0)):
        swap[i] = word[also[i]] < word[other[i]]
    other, n_other = np.where(swap, also, other), np.where(swap, n_also, n_other)
    near = count > 0
    form = np.where(n_other >= RATIO * n, word[other], None) if len(key) else word
    return pd.DataFrame({"word": word[near], "n_near": count[near], "form_n": n_other[near], "form": form[near]})


def _scan_sorted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: pd.DataFrame | None = None
    for b in chain(batches, [None]):
        df = held if b is None else b if held is None else pd.concat([held, b], ignore_index=True)
        if df is None or not len(df):
            continue
        key = df["key"].to_numpy()
        # the last run may go on in the next batch
        end = len(key) if b is None else int(np.flatnonzero(np.append(True, key[1:] != key[:-1]))[-1])
        held = df.iloc[end:]
        yield _scan(key[:end], df["x"].to_numpy()[:end], df["n"].to_numpy()[:end])


def neighbours(words: DataFrame) -> DataFrame:
    """Per sorted run and member: word, n_near, form_n (best neighbour's count), form (if its count suffices)."""
    ordered = rotations(words).repartition("key").sortWithinPartitions("key", "x")
    return ordered.mapInPandas(_scan_sorted, "word string, n_near long, form_n long, form string")


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of words with a form: the last of the chain of forms."""
    steps = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "spelling-roots")
    while not steps.where("moved").isEmpty():
        far = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        step = steps.join(far, "root", "left")
        steps = materialize(step.select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")), "spelling-roots")
    return steps.select("word", "root")


def group(docs: DataFrame) -> DataFrame:
    """Per word: word, n, n_near, form, form_n, root."""
    words = materialize(count_words(docs.select("doc_id", "text")), "spelling-words")
    found = neighbours(words).unionByName(words, allowMissingColumns=True)
    rank = F.struct((-F.col("form_n")).alias("least"), F.col("form").alias("form"))
    found = found.groupBy("word").agg(
        F.max("n").alias("n"), F.coalesce(F.sum("n_near"), F.lit(0)).alias("n_near"), F.min(F.when(F.col("form").isNotNull(), rank)).alias("best")
    )
    found = materialize(found.select("word", "n", "n_near", "best.form", (-F.col("best.least")).alias("form_n")), "spelling-forms")
    roots = follow(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


#: crc32 of UTF-8 text s (ASCII and U+0080 to U+07FF) in SQL, over a table of the 256 byte steps.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS steps
  FROM range(256) t(b))"""


def crc_sql(s: str) -> str:
    """SQL for the unsigned crc32 of the text expression ``s``; needs :data:`CRC_TABLE` in scope."""
    utf8 = f"flatten(list_transform(string_split({s}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))"
    return f"xor(list_reduce([4294967295::BIGINT] || {utf8}::BIGINT[], lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295)"


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]{{7,}}')), '{UPPER}', '{LOWER}') AS run
  FROM documents),
hashed AS (SELECT run, {crc_sql("id || ':' || run")} AS h FROM runs, crc_table),
edited AS (
  SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, (h % length(run))::INT) || substring(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, count(*) AS n FROM edited WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2),
cuts AS (
  SELECT word, n, i, substring(word, 1, i - 1) || '*' || substring(word, i + 1) AS hole, substring(word, 1, i - 1) || substring(word, i + 1) AS rest
  FROM words, range(1, 40) r(i) WHERE i <= length(word)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cuts c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cuts c JOIN words w ON c.rest = w.word),
best AS (SELECT word, count(*) AS n_near, min((-near_n, near)) AS top FROM pairs GROUP BY word),
forms AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top[1] >= 10 * n THEN top[2] END AS form, CASE WHEN -top[1] >= 10 * n THEN -top[1] END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (
  SELECT word, word AS root, form AS next FROM forms
  UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.next = f.word)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.root FROM forms f JOIN chain c ON f.word = c.word AND c.next IS NULL
"""
