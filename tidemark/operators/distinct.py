"""Unique visitors per window: exact (A6), bitmap (A7/A8), estimate, running."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tidemark.functions.eventtime import interval
from tidemark.functions.hashing import DEFAULT_BITS, DEFAULT_SEED, poly_hash
from tidemark.operators.ordered import running_sum

# Width of the parts a window is always split into for the running count.
RUNNING_BUCKET = "1 minute"


def _tumble(df: DataFrame, size: str, ts: str) -> DataFrame:
    w = F.window(ts, size)
    return df.withColumn("window_start", w.start).withColumn("window_end", w.end)


def distinct_count(df: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                   out: str = "uv") -> DataFrame:
    """Exact distinct users per tumbling window.

    Catalyst plans one distinct aggregate as (window, user) dedup first, then
    a count per window, both with partial aggregation, so neither a window
    nor a hot user gathers in one task.
    """
    return (_tumble(df, size, ts).groupBy("window_start", "window_end")
            .agg(F.count_distinct(user).alias(out)))


def bitmap_offset(user: str, seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS):
    return poly_hash(F.col(user).cast("string"), seed, bits)


def bitmap_distinct_count(df: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                          out: str = "uv", seed: int = DEFAULT_SEED, bits: int = DEFAULT_BITS) -> DataFrame:
    """Distinct hashed offsets per window, counted through bitmaps.

    The offset space (2^bits) is cut into 32,768-bit buckets; each
    (window, bucket) is one bitmap aggregate (partial per task, OR-merged),
    and the per-bucket bit counts add up to the window's count.  Equal to
    the reference's single bit string per window, collisions included (D11).
    """
    off = bitmap_offset(user, seed, bits)
    per_bucket = (_tumble(df, size, ts)
                  .select("window_start", "window_end",
                          F.bitmap_bucket_number(off).alias("_b"), F.bitmap_bit_position(off).alias("_p"))
                  .groupBy("window_start", "window_end", "_b")
                  .agg(F.bitmap_count(F.bitmap_construct_agg("_p")).alias("_n")))
    return per_bucket.groupBy("window_start", "window_end").agg(F.sum("_n").cast("long").alias(out))


def approx_distinct_count(df: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                          out: str = "uv", lg_k: int = 12) -> DataFrame:
    """The idiomatic estimate: an HLL sketch per window (mergeable across panes)."""
    return (_tumble(df, size, ts).groupBy("window_start", "window_end")
            .agg(F.hll_sketch_estimate(F.hll_sketch_agg(F.col(user), lg_k)).alias(out)))


def running_distinct(df: DataFrame, size: str, user: str = "user_id", ts: str = "ts",
                     seq: str = "seq", out: str = "uv", repeats_only: bool = True,
                     key: str | None = None, bucket: str = RUNNING_BUCKET) -> DataFrame:
    """After each event, the number of distinct users seen so far in its window.

    ``key`` None dedups on ``user`` exactly; ``key='offset'`` dedups on the
    hashed bitmap offset as the reference does.  With ``repeats_only`` only
    events of an already-seen user are returned (the reference emits on a
    repeat, D10).  First sightings come from a (window, user) aggregate, so a
    hot user is merged map-side.  A window is always split into buckets of
    ``bucket``; the count before a bucket is the number of first sightings in
    earlier ones, read off the same aggregate.

    Rows that tie in (ts, seq) go by user, and a user's rows that tie are one
    sighting: the first of them counts.
    """
    base = _tumble(df, size, ts)
    base = base.withColumn("_u", bitmap_offset(user) if key == "offset" else F.col(user))
    first = (base.groupBy("window_end", "_u")
             .agg(F.min(F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"))).alias("_first")))
    totals = (first.groupBy("window_end", F.window(F.col("_first.t"), bucket).start.alias("_bk"))
              .agg(F.count(F.lit(1)).alias("_tot")))
    earliest = (F.col("_first.t") == F.col(ts)) & F.col("_first.s").eqNullSafe(F.col(seq))
    joined = base.join(first, ["window_end", "_u"]).withColumn("_e", earliest).drop("_first")
    # The row before in the order of the running sum, whose window and sort this one shares.
    here = F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"), F.col("_u").alias("u"))
    before = Window.partitionBy("window_end", "_bk").orderBy(ts, seq, "_u")
    flagged = (joined.withColumn("_bk", F.window(ts, bucket).start)
               .withColumn("_is_first", F.col("_e") & ~F.lag(here).over(before).eqNullSafe(here)).drop("_e"))
    # One row per window and bucket (a window has size / bucket of them), so that buckets without
    # a first sighting of their own get the count before them.
    grid = (totals.select("window_end").distinct()
            .withColumn("_lo", F.window(F.col("window_end") - interval(size), bucket).start)
            .select("window_end", F.explode(F.sequence("_lo", F.col("window_end") - interval("1 second"), interval(bucket))).alias("_bk")))
    edges = grid.join(totals, ["window_end", "_bk"], "left").fillna(0, ["_tot"])
    counted = running_sum(flagged, ["window_end"], [ts, seq, "_u"], F.col("_is_first").cast("long"), out, bucket, totals=edges)
    if repeats_only:
        counted = counted.where(~F.col("_is_first"))
    return counted.drop("_u", "_is_first")
