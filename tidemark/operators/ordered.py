"""Ordered scans per key that survive a hot key, in one exchange of the rows.

A plain ``Window.partitionBy(key)`` puts all rows of one key in one task.  These helpers split
every key by time, always, without looking for hot keys first:

* :func:`running_sum` works inside (key, time bucket); what came before a bucket is added from a
  per-bucket aggregate (partial sums before its shuffle, at most span / bucket rows per key).
* :func:`next_within` finds a partner at most ``within`` later.  A row near the start of a
  bucket is copied into the bucket before it, so every partner stands in the same
  (key, bucket) group as the row that looks for it: one scan, one exchange, no join back.
  A group too large for a task goes through :mod:`tidemark.operators.carry` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_BUCKET = "1 hour"
# A bucket of several limits keeps the copied share small (one part in LOOKAHEAD).
LOOKAHEAD = 4


def _bucket(ts: str | Column, width: str) -> Column:
    return F.window(ts, width).start


def running_sum(df: DataFrame, keys: list[str], order: list[str | Column], value: Column, out: str,
                bucket: str = DEFAULT_BUCKET, ts: str | None = None, totals: DataFrame | None = None) -> DataFrame:
    """Inclusive running sum of ``value`` per key in ``order`` (its first column is the time column).

    With ``value = lit(1)`` this is ``row_number()`` per key, exactly, when ``order`` is total.
    ``totals`` may give the sums per (keys, ``_bk``) as column ``_tot`` where the caller has them; a
    column ``_bk`` in ``df`` is taken as the bucket.
    """
    ts = ts or order[0]
    based = (df if "_bk" in df.columns else df.withColumn("_bk", _bucket(ts, bucket))).withColumn("_val", value)
    inner = Window.partitionBy(*keys, "_bk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    b = based.withColumn("_in", F.sum("_val").over(inner))
    if totals is None:
        totals = based.groupBy(*keys, "_bk").agg(F.sum("_val").alias("_tot"))
    before = Window.partitionBy(*keys).orderBy("_bk").rowsBetween(Window.unboundedPreceding, 0)
    # The sum of a bucket without rows of its own still counts for later ones, so the
    # offset is the running total up to the bucket less the bucket's own.
    offsets = totals.select(*keys, "_bk", (F.sum("_tot").over(before) - F.col("_tot")).alias("_off"))
    return (b.join(offsets, [*keys, "_bk"], "left")
            .withColumn(out, (F.col("_in") + F.coalesce(F.col("_off"), F.lit(0))).cast("long"))
            .drop("_bk", "_val", "_in", "_off"))


def bucket_of(df: DataFrame, ts: str, within_seconds: int, lookahead: int = LOOKAHEAD) -> Column:
    """Number of the time bucket that :func:`next_within` puts a row in."""
    return F.floor(_seconds_of(df, ts) / (max(1, within_seconds) * lookahead))


def _seconds_of(df: DataFrame, ts: str) -> Column:
    return F.unix_timestamp(ts) if dict(df.dtypes)[ts] == "timestamp" else F.timestamp_diff(
        "SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def next_within(df: DataFrame, keys: list[str], order: list[str], cond: Column, payload: list[str], out: str,
                within_seconds: int, lookahead: int = LOOKAHEAD) -> DataFrame:
    """Add ``out``: struct of ``payload`` of the nearest later row of the key (in ``order``, time
    first) for which ``cond`` holds, looking at least ``within_seconds`` ahead.

    A row further ahead than the limit may or may not be found; callers compare the times.
    """
    ts = order[0]
    width = max(1, within_seconds) * lookahead
    own = F.floor(F.col("_at") / width)
    # <=: a time cut down to its second may hide up to one second of the distance
    early = F.col("_at") - own * width <= within_seconds
    copies = F.when(early, F.array(own, own - 1)).otherwise(F.array(own))
    spread = (df.withColumn("_at", _seconds_of(df, ts)).select("*", F.posexplode(copies).alias("_copy", "_bk"))
              .withColumn("_cand", F.when(cond, F.struct(*[F.col(c).alias(c) for c in payload]))))
    w = Window.partitionBy(*keys, "_bk").orderBy(*[F.col(c).desc() for c in order]).rowsBetween(Window.unboundedPreceding, -1)
    return (spread.withColumn(out, F.last("_cand", ignorenulls=True).over(w)).where("_copy = 0")
            .drop("_at", "_copy", "_bk", "_cand"))
