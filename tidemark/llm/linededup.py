"""Line dedup across documents (operator 12), DataFrame functions only.

Texts are split at ``\\n``; a line's key is the line stripped of white space at both ends, A-Z lower-cased.
Keys of at least ``min_chars`` code points found in at least ``min_docs`` documents lose all their lines,
except in the largest ``doc_id`` that holds them.

How: one row (document, position, 128-bit hash) per long enough line is written once; lines are counted
per hash with partial sums, so a line that a third of all documents share is one row per task.  Only hashes
with ``min_docs`` lines or more go on: their rows are joined to the count by (hash, salt), distinct
documents are counted exactly, and the positions to drop are gathered per document.  A text is put together
from the stretches between its dropped positions, in one pass, whatever their number.

Defined cases: a null or empty text is one empty line and gives an empty text; a document is its ``doc_id``,
so rows that repeat a ``doc_id`` count once and lines stay in all rows of the largest one; a null ``doc_id``
counts as one id below all others; texts that lose every line become empty; an empty table gives an empty
result.  Extra columns are kept; those called ``n_lines`` or ``n_dropped`` in any case are replaced.  ``\\r`` and other
white space stay in the lines that are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, lookup, scratch

# White space [\x20\x09-\x0D], and the letters that are lower-cased.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ADDED = ["n_lines", "n_dropped"]


def lines_of(text: Column) -> Column:
    """The lines of a text; null and empty texts hold one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """What makes two lines the same."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def _hashes(key: Column) -> list[Column]:
    # two 64-bit hashes of different seeds: the second starts from the hash of a constant
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("second"), key).alias("h2")]


def _row(doc_id: Column, text: Column) -> list[Column]:
    """What tells documents apart: equal rows lose equal lines."""
    return [doc_id.alias("d"), F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary"))).alias("t")]


def dropped_positions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40,
                      min_docs: int = 5) -> DataFrame:
    """(d, t, ``gone``): id and text hash of the documents that lose lines, with the sorted positions of those (from 0)."""
    lines = docs.select(*_row(F.col(doc_id), F.col(text)), F.posexplode(F.transform(lines_of(F.col(text)), key_of)).alias("at", "key"))
    kept = lines.where(F.char_length("key") >= min_chars).select("d", "t", "at", *_hashes(F.col("key")))
    kept = scratch(kept, "line-hashes")
    often = kept.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).drop("n")
    found = scratch(lookup(kept, scratch(often, "line-often"), ["h1", "h2"], F.col("d"), how="inner"), "line-found")
    per_doc = found.groupBy("h1", "h2", "d").agg(F.lit(1).alias("one"))
    spread = (per_doc.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("d").alias("last"))
              .where(F.col("docs") >= min_docs).drop("docs"))
    lost = lookup(found, scratch(spread, "line-spread"), ["h1", "h2"], F.col("d"), how="inner").where(~F.col("d").eqNullSafe(F.col("last")))
    return lost.groupBy("d", "t").agg(F.array_sort(F.collect_set("at")).alias("gone"))


def drop_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int = 40,
                        min_docs: int = 5) -> DataFrame:
    """``docs`` with the remaining text, ``n_lines`` (before) and ``n_dropped``."""
    docs = docs.drop(*[c for c in docs.columns if c.lower() in ADDED and c not in (doc_id, text)])
    gone = scratch(dropped_positions(docs, doc_id, text, min_chars, min_docs), "line-gone")
    d, t, at = (fresh(docs, c) for c in ("_d", "_t", "_gone"))
    small = gone.select(F.col("d").alias(d), F.col("t").alias(t), F.col("gone").alias(at))
    names = [c for c in docs.columns if c != text]
    own = _row(F.col(doc_id), F.col(text))
    joined = docs.join(small, own[0].eqNullSafe(F.col(d)) & (own[1] == F.col(t)), "left")
    lines = lines_of(F.col(text))
    holes = F.coalesce(F.col(at), F.array().cast("array<int>"))
    stretches = F.arrays_zip(F.concat(F.array(F.lit(0)), F.transform(holes, lambda p: p + 1)).alias("a"),
                             F.concat(holes, F.array(F.size(lines))).alias("b"))
    whole = joined.withColumns({fresh(docs, "_lines"): lines, fresh(docs, "_stretches"): stretches})
    ls, ss = whole.columns[-2], whole.columns[-1]
    left = F.flatten(F.transform(ss, lambda s: F.slice(F.col(ls), s["a"] + 1, s["b"] - s["a"])))
    return whole.select(*names, F.when(F.col(at).isNull(), F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(left, "\n")).alias(text),
                        F.size(ls).cast("long").alias("n_lines"), F.when(F.col(at).isNull(), 0).otherwise(F.size(at)).cast("long").alias("n_dropped"))


ORACLE = """
WITH l AS (
  SELECT doc_id, u.pos, u.line, translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest([{'pos': i, 'line': x} FOR x, i IN string_split(coalesce(text, ''), chr(10))]) AS u FROM documents)),
k AS (SELECT key, max(doc_id) AS last FROM l WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT l.*, k.key IS NOT NULL AND l.doc_id <> k.last AS gone FROM l LEFT JOIN k ON l.key = k.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
