"""Merkle manifest of a dataset (operator 11): leaves, one tree per group, one root, proofs.

A row's leaf is H (lowercase hex sha256, inputs concatenated, digests as hex text) of its fields, each
``-`` if null, else UTF-8 byte count, ``:``, value.  In a group leaves ascend by ``order``; while more
than one node remains, every ``arity`` consecutive ones (the last run may hold fewer, even one) become
their H.  The last node is the group's subroot; the subroots, by group, reduce likewise to the root.

How: rows get their position in the group (:mod:`tidemark.operators.layout`, no group is gathered), and
``arity ** LEVELS`` consecutive nodes form a block that no run crosses.  In a block each node of level l
stands in the row of its first leaf, so its siblings are lag and lead columns at multiples of
``arity ** l``, masked by the node's slot in its run and by the run's length, and the first child's row
hashes the parent.  A leaf's ancestor is the last such row at or before it.  Block roots are the nodes of
the next tier: a tree of n leaves takes ``log(n) / (LEVELS * log(arity))`` tiers, each of evenly sized
windows, whatever share of the rows a group holds.

Defined cases: a null group is a group of its own, first; a null ``order`` sorts first; ties and repeated
rows go by leaf, then in any order (equal leaves are interchangeable in the tree; each has its own place
and proof); null and empty fields differ (``-``, ``0:``); texts of any length are hashed whole; an empty
table gives an empty manifest; columns that are not fields do not matter.  Names that clash with
those of the result raise ``ValueError``.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import scratch
from tidemark.operators.layout import lay_out, positions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels reduced in one window pass: blocks of 2 ** 10 rows.
LEVELS = 10
RESULT = ("leaf", "subroot", "root", "path")


def digest(*parts: Column) -> Column:
    """H: lowercase hex sha256 of the parts' concatenation."""
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """Leaf of a row's fields, in the given order."""
    def said(c: Column) -> Column:
        v = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v), F.lit("-"))

    return digest(*[said(c) for c in fields])


def _tier(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``nodes`` (g, pos, n, node, ...) with ``block``, ``top`` (the block's root, in its first row) and
    ``path`` (per level below it the siblings to the left and right, as two strings)."""
    width = arity ** levels
    t = nodes.withColumn("block", F.floor(F.col("pos") / width)).withColumn("idx", F.col("pos") % width)
    rows = Window.partitionBy("g", "block").orderBy("idx")
    t = t.withColumn("top", F.col("node"))
    for level in range(levels):
        step = arity ** level
        slot = F.floor(F.col("idx") / step) % arity
        here = (F.col("idx") % step == 0) & (F.col("n") > step)
        lags = [F.when(here & (slot >= j), F.lag("top", j * step).over(rows)) for j in range(arity - 1, 0, -1)]
        leads = [F.when(here & (slot + j < arity) & (F.col("pos") + j * step < F.col("n")), F.lead("top", j * step).over(rows))
                 for j in range(1, arity)]
        t = t.withColumns({f"l{level}": F.concat_ws("", *lags), f"r{level}": F.concat_ws("", *leads)})
        parent = F.when(here, digest(F.col("top"), F.col(f"r{level}"))).otherwise(F.col("top"))
        t = t.withColumn("top", F.when(F.col("idx") % (step * arity) == 0, parent))
        t = t.withColumn(f"s{level}", F.when(here, F.struct(F.col(f"l{level}").alias("l"), F.col(f"r{level}").alias("r"))))
    so_far = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    above = F.array(*[F.last(f"s{level}", ignorenulls=True).over(so_far) for level in range(levels)])
    return (t.withColumn("path", F.filter(above, lambda s: s.isNotNull()))
            .drop("idx", *[f"{c}{level}" for c in "lrs" for level in range(levels)]))


def _tiers(nodes: DataFrame, arity: int, levels: int, name: str) -> list[DataFrame]:
    """The tiers of all groups' trees, from ``nodes`` (g, pos, n, node, ...) up."""
    width = arity ** levels
    most = nodes.agg(F.max("n")).first()[0] or 0
    tiers = [scratch(_tier(nodes, arity, levels), f"{name}-0")]
    while most > width:
        most = math.ceil(most / width)
        up = (tiers[-1].where(F.col("pos") % width == 0)
              .select("g", F.col("block").alias("pos"), F.ceil(F.col("n") / width).alias("n"), F.col("top").alias("node")))
        tiers.append(scratch(_tier(up, arity, levels), f"{name}-{len(tiers)}"))
    return tiers


def _last(tiers: list[DataFrame]) -> DataFrame:
    """(g, top): the last node of every group."""
    return tiers[-1].where("pos = 0").select("g", "top")


def _descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """The first tier's rows with ``path`` up to the group's last node and on through ``above``
    (g, ``path``, more): one row per group, met by at most a block's rows of it in the last tier, then
    handed down from block to block."""
    more = [c for c in above.columns if c not in ("g", "path")]
    up = above.select(F.col("g").alias("_g"), F.col("path").alias("_up"), *more)
    t = tiers[-1]
    whole = t.join(up, t["g"].eqNullSafe(up["_g"])).withColumn("path", F.concat("path", "_up"))
    for t in reversed(tiers[:-1]):
        up = whole.select(F.col("g").alias("_g"), F.col("pos").alias("_b"), F.col("path").alias("_up"), *more)
        whole = (t.join(up, t["g"].eqNullSafe(up["_g"]) & (t["block"] == up["_b"]))
                 .withColumn("path", F.concat("path", "_up")).drop("_b"))
    return whole.drop("_g", "_up")


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", arity: int = 2,
             also: Mapping[str, Column] | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per input row: ``order``, ``group``, ``also``, ``leaf``, ``subroot``, ``root`` and ``path``
    (from the leaf to the root, per level the strings of the siblings to its left and right)."""
    also = dict(also or {})
    names = [order, group, *also]
    clash = {c.lower() for c in names} & set(RESULT)
    if clash or len({c.lower() for c in names}) < len(names):
        raise ValueError(f"columns {names} clash with each other or with {list(RESULT)}")
    leaves = scratch(df.select(F.col(group).alias("g"), F.col(order).alias("o"), leaf_of([F.col(f) for f in fields]).alias("node"),
                               *[c.alias(f"also_{i}") for i, c in enumerate(also.values())],
                               F.monotonically_increasing_id().alias("tie")), "merkle-leaves")
    placed = positions(lay_out(leaves, ["g", "o", "node", "tie"], "merkle"), ["g"]).drop("tie")
    trees = _tiers(placed, arity, levels, "merkle-tier")
    tops = lay_out(_last(trees).select(F.lit(0).alias("g"), F.col("g").alias("group"), F.col("top").alias("node")), ["group"], "merkle-top")
    crown = _tiers(positions(tops, ["g"]), arity, levels, "merkle-crown")
    found = _last(crown).first()  # one digest
    no_more = crown[-1].where("pos = 0").select("g", F.filter("path", lambda s: F.lit(False)).alias("path"))
    above = _descend(crown, no_more).select(F.col("group").alias("g"), "path", F.col("node").alias("subroot"))
    return _descend(trees, above).select(
        F.col("o").alias(order), F.col("g").alias(group), *[F.col(f"also_{i}").alias(c) for i, c in enumerate(also)],
        F.col("node").alias("leaf"), "subroot", F.lit(found and found["top"]).cast("string").alias("root"), "path")


def folded(leaf: Column, path: Column) -> Column:
    """The root recomputed from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["l"], node, s["r"]))


def proof_digest(path: Column) -> Column:
    """H of the siblings, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["l"], s["r"]))), 256)


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT doc_id, doc_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)
  UNION ALL
  SELECT doc_id, s, k + 1, xor(x >> 1, (x & 1) * 3988292384)
  FROM (SELECT doc_id, s, k, CASE WHEN k % 8 = 0 THEN xor(c, ascii(s[k // 8 + 1])::BIGINT) ELSE c END AS x FROM crc WHERE k < 8 * len(s))),
crc32_of AS (SELECT doc_id, xor(c, 4294967295) AS c FROM crc WHERE k = 8 * len(s)),
f AS (
  SELECT doc_id, lang, coalesce(octet_length(encode(doc_id::VARCHAR)) || ':' || doc_id, '-')
         || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         n_chars, coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
  FROM documents),
h AS (SELECT doc_id, lang, sha256(head || coalesce(octet_length(encode(n_chars::VARCHAR)) || ':' || n_chars, '-') || tail) AS leaf,
             sha256(head || coalesce(octet_length(encode((n_chars + 1)::VARCHAR)) || ':' || (n_chars + 1), '-') || tail) AS changed
      FROM f),
d AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n
      FROM h),
t AS (
  SELECT lang, 0 AS lvl, pos, n, leaf AS node FROM d
  UNION ALL
  SELECT lang, lvl + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM t WHERE n > 1 GROUP BY lang, lvl, pos // 2),
s AS (SELECT lang, node AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS lvl, pos, n, subroot AS node FROM s
  UNION ALL
  SELECT lvl + 1, pos // 2, (any_value(n) + 1) // 2, sha256(string_agg(node, '' ORDER BY pos))
  FROM u WHERE n > 1 GROUP BY lvl, pos // 2),
steps AS (
  SELECT d.lang, d.pos, t.lvl AS k, (d.pos >> t.lvl) & 1 AS slot, any_value(sib.node) AS sib
  FROM d JOIN t ON t.lang IS NOT DISTINCT FROM d.lang AND t.n > 1 AND t.pos = d.pos >> t.lvl
  LEFT JOIN t sib ON sib.lang IS NOT DISTINCT FROM d.lang AND sib.lvl = t.lvl AND sib.pos = xor(d.pos >> t.lvl, 1)
  GROUP BY ALL
  UNION ALL
  SELECT d.lang, d.pos, 1000 + u.lvl, (s.pos >> u.lvl) & 1, sib.node
  FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN u ON u.n > 1 AND u.pos = s.pos >> u.lvl
  LEFT JOIN u sib ON sib.lvl = u.lvl AND sib.pos = xor(s.pos >> u.lvl, 1)),
paths AS (SELECT lang, pos, list(slot ORDER BY k) AS slots, list(coalesce(sib, '') ORDER BY k) AS sibs FROM steps GROUP BY lang, pos),
whole AS (
  SELECT d.doc_id, d.lang, d.pos, d.leaf, coalesce(slots, []) AS slots, coalesce(sibs, []) AS sibs,
         CASE WHEN crc32_of.c % 7 = 0 THEN d.changed ELSE d.leaf END AS start
  FROM d LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM d.lang AND p.pos = d.pos
  LEFT JOIN crc32_of ON crc32_of.doc_id = d.doc_id),
r AS (
  SELECT lang, pos, 0 AS k, start AS node, slots, sibs FROM whole
  UNION ALL
  SELECT lang, pos, k + 1, sha256(CASE WHEN slots[k + 1] = 1 THEN sibs[k + 1] || node ELSE node || sibs[k + 1] END), slots, sibs
  FROM r WHERE k < len(slots))
SELECT w.doc_id, w.leaf, s.subroot, root.node AS root, sha256(array_to_string(w.sibs, '')) AS proof_sha256, r.node AS folded_root,
       r.node = root.node AS verified
FROM whole w JOIN s ON s.lang IS NOT DISTINCT FROM w.lang
JOIN r ON r.lang IS NOT DISTINCT FROM w.lang AND r.pos = w.pos AND r.k = len(r.slots)
CROSS JOIN (SELECT node FROM u WHERE n = 1) root
"""
