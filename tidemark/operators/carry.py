"""Look-ahead per key as a segmented scan over range partitions.

A key's rows in one time bucket can still be too many for a task (a burst of a hot user).  Here rows
are laid out by (key, time, tie) in partitions of equal size (:mod:`tidemark.operators.layout`); each
partition answers from its own rows, and what it cannot answer comes from a summary of the partitions
after it: per (key, partition) the first candidate.  Summaries combine by "the first one there is", an
associative operator, over one small row per key and partition.  No group of a key is ever gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.layout import PART, ROW, lay_out, runs, with_runs
from tidemark.operators.ordered import LOOKAHEAD, bucket_of, next_within

# Rows of one (key, bucket) group that one task takes in its stride; beyond it rows are laid out by range.
MAX_GROUP = 2_000_000


def next_partner(df: DataFrame, keys: list[str], order: list[str], cond: Column, payload: list[str], out: str) -> DataFrame:
    """Add ``out``: struct of ``payload`` of the nearest later row of the key (in ``order``) for which ``cond``
    holds, however far ahead."""
    head = F.when(cond, F.struct(F.col(ROW).alias("_at"), F.struct(*[F.col(c).alias(c) for c in payload]).alias("_p")))
    # One partition of the layout to a task: the windows below need no further exchange.
    laid = lay_out(df, [*keys, *order], "scan").repartitionByRange(PART).withColumn("_cand", head)
    later = Window.partitionBy(*keys, PART).orderBy(F.col(ROW).desc()).rowsBetween(Window.unboundedPreceding, -1)
    local = laid.withColumn("_own", F.last("_cand", ignorenulls=True).over(later))
    beyond = Window.partitionBy(*keys).orderBy(F.col(PART).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = (runs(laid, keys, F.min_by("_cand", F.when(F.col("_cand").isNotNull(), F.col(ROW))).alias("_head"))
             .select(*keys, PART, F.last("_head", ignorenulls=True).over(beyond).alias("_carry")))
    return (with_runs(local, carry, keys).withColumn(out, F.coalesce(F.col("_own._p"), F.col("_carry._p")))
            .drop("_cand", "_own", "_carry", PART, ROW))


def largest_group(df: DataFrame, keys: list[str], ts: str, within_seconds: int, lookahead: int = LOOKAHEAD) -> int:
    """Rows of the largest (key, bucket) group that :func:`next_within` would put in one task."""
    sizes = df.groupBy(*keys, bucket_of(df, ts, within_seconds, lookahead).alias("_bk")).agg(F.count(F.lit(1)).alias("_n"))
    return sizes.agg(F.max("_n")).first()[0] or 0


def look_ahead(df: DataFrame, keys: list[str], order: list[str], cond: Column, payload: list[str], out: str,
               within_seconds: int, max_group: int = MAX_GROUP) -> DataFrame:
    """The partner at most ``within_seconds`` ahead: one exchange by (key, bucket) where the measured largest
    group fits a task, else the range layout.  Both give the same rows."""
    narrow = df.select(*keys, order[0])
    if largest_group(narrow, keys, order[0], within_seconds) <= max_group:
        return next_within(df, keys, order, cond, payload, out, within_seconds)
    return next_partner(df, keys, order, cond, payload, out)
