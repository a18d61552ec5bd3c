"""Mixing sources to target weights (operator 1), DataFrame functions only.

Words per source are summed, each source gets a target, and every document of a source is
emitted ``floor(rate)`` times plus one more time with probability ``rate - floor(rate)``,
where ``rate = target / words of the source``.  The draw is a hash of (seed, doc_id, text), so a
rerun, a retried task or another partitioning gives the same mix, and rows that share an id draw apart.

Targets: ``budget_share`` times all words is shared by the sources' weights; a source may give
at most ``max_repeat`` times its words, and what it cannot take is shared by weight among the
others until none is above.  That level has a closed form: with sources in order of
``cap / weight``, ``level = max over prefixes of (budget - caps of the prefix) / weights of the
rest`` and ``target = min(cap, weight * level)``.

Defined cases: null or empty text has 0 words and is taken 0 words (it is still emitted by its
rate); a null source is a source of its own, last in code-point order; a null doc_id or text draws as
an empty one; rows equal in both draw alike; an empty table gives an empty mix; a source without words
has target 0 and rate 0.  Input columns that clash with the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, lookup, scratch

WORD = r"[^\x20\x09-\x0D]+"
ADDED = ["size", "source_size", "target", "copies", "taken"]
SEED = "mix-1"


def words_in(text: Column) -> Column:
    """Number of words of a text; null counts as empty."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, text: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 52 bits of md5(seed:doc_id:md5(text))."""
    own = F.md5(F.coalesce(text.cast("string"), F.lit("")).cast("binary"))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), own)
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def source_targets(sizes: DataFrame, weights: Sequence[int], budget_share: float, max_repeat: float) -> DataFrame:
    """(source, source_size, target) from (source, size) rows.

    Works on one row per source after the partial sums; only the ranking and the prefix sums
    run over that small table in one place (its size is the number of sources, not of rows).
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]),
                     ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = (per.withColumn("weight", w)
              .withColumn("cap", F.lit(float(max_repeat)) * F.col("source_size"))
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    everything = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = everything.rowsBetween(Window.unboundedPreceding, -1)
    rest = everything.rowsBetween(0, Window.unboundedFollowing)
    whole = everything.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.lit(float(budget_share)) * F.sum("source_size").over(whole)
              - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(rest))
    per = per.withColumn("level", level)
    return per.select("source", "source_size",
                      F.least("cap", F.col("weight") * F.max("level").over(whole)).alias("target"))


def plan_mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget_share: float = 1.5,
             max_repeat: float = 2.0, seed: str = SEED) -> DataFrame:
    """(doc_id, source) rows with ``size, source_size, target, copies, taken``, one per input row.

    The text is read once: its word counts are written with the ids, and only those rows go on.
    """
    draw = uniform(F.col("doc_id"), F.col("text"), seed)
    sized = scratch(docs.select("doc_id", "source", words_in(F.col("text")).alias("size"), draw.alias("_draw")), "mix-sizes")
    return _with_copies(sized, sized, weights, budget_share, max_repeat, "_draw").drop("_draw")


def mix(docs: DataFrame, weights: Sequence[int] = (3, 1, 2), budget_share: float = 1.5,
        max_repeat: float = 2.0, seed: str = SEED) -> DataFrame:
    """The mix itself: every document ``copies`` times, with ``copy`` = 1, 2, ..."""
    draw = fresh(docs, "_draw")
    base = (docs.drop(*ADDED, "copy").withColumn("size", words_in(F.col("text")))
            .withColumn(draw, uniform(F.col("doc_id"), F.col("text"), seed)))
    planned = _with_copies(base, base.select("source", "size"), weights, budget_share, max_repeat, draw)
    emitted = planned.where("copies > 0").drop(draw)
    return emitted.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))


def _with_copies(base: DataFrame, sizes: DataFrame, weights, budget_share, max_repeat, draw: str) -> DataFrame:
    # Written first, so the planner knows its size: under the session's threshold it is broadcast
    # and the documents stay where they are, beyond it the salted join deals them out.
    targets = scratch(source_targets(sizes, weights, budget_share, max_repeat), "mix-targets")
    out = lookup(base, targets, ["source"], F.col(draw))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra = (F.col(draw) < rate - F.floor(rate)).cast("long")
    return (out.withColumn("copies", F.floor(rate).cast("long") + extra)
               .withColumn("taken", F.col("size") * F.col("copies")))


ORACLE = """
WITH d AS (
  SELECT doc_id, source, md5(coalesce(text, '')) AS own,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight,
             2.0::DOUBLE * source_size AS cap FROM s),
o AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget,
             row_number() OVER (ORDER BY cap / weight, encode(source) NULLS LAST) AS k FROM r),
l AS (SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM o),
t AS (SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM l),
j AS (SELECT d.doc_id, d.size, t.source_size, t.target,
             CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate,
             ('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '') || ':' || d.own), 1, 13))::BIGINT
               / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM j
"""
