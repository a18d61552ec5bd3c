"""Streaming interval matching of two keyed streams.

One full-outer stream-stream join on key + time range: matched rows carry
both sides; a pay whose range has passed the watermark without a receipt is
emitted with a NULL receipt, and the other way round.  Both inputs carry a
watermark; the slower one governs (``multipleWatermarkPolicy=min``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.eventtime import ASCENDING, interval, watermark


def match_streams(pays: DataFrame, receipts: DataFrame, key: str, lower: str, upper: str,
                  ts: str = "ts", delay: str = ASCENDING) -> DataFrame:
    """Full outer interval join; ``tag`` is matched / unmatched_pay / unmatched_receipt."""
    p = watermark(pays, ts, delay)
    r = watermark(receipts, ts, delay)
    P = p.select(*[F.col(c).alias("p_" + c) for c in p.columns])
    R = r.select(*[F.col(c).alias("r_" + c) for c in r.columns])
    cond = ((F.col("p_" + key) == F.col("r_" + key))
            & (F.col("r_" + ts) >= F.col("p_" + ts) + interval(lower))
            & (F.col("r_" + ts) <= F.col("p_" + ts) + interval(upper)))
    j = P.join(R, cond, "fullOuter")
    tag = (F.when(F.col("p_" + key).isNotNull() & F.col("r_" + key).isNotNull(), F.lit("matched"))
           .when(F.col("r_" + key).isNull(), F.lit("unmatched_pay"))
           .otherwise(F.lit("unmatched_receipt")))
    return j.withColumn("tag", tag)


def _bucket_secs(ts_col, width_s: int):
    return F.floor(F.unix_seconds(ts_col) / width_s)


def match_streams_bucketed(pays: DataFrame, receipts: DataFrame, key: str, lower: str, upper: str,
                           ts: str = "ts", delay: str = ASCENDING, width: str | None = None) -> DataFrame:
    """J1/J3/J4 with range-join buckets on streams: a hot key's state is split by time.

    Two left-outer stream-stream joins keyed by (key, bucket): pays keep one
    bucket and receipts are copied into every bucket their range reaches
    (pairs and unmatched pays once each); the mirrored join gives unmatched
    receipts once each.  Same tags as :func:`match_streams`.
    """
    from tidemark.operators.windows import seconds

    def signed(d):
        d = d.strip()
        return -seconds(d[1:]) if d.startswith("-") else seconds(d)
    lo, hi = signed(lower), signed(upper)
    w = seconds(width) if width else max(hi - lo, 1)
    p = watermark(pays, ts, delay)
    r = watermark(receipts, ts, delay)
    P = p.select(*[F.col(c).alias("p_" + c) for c in p.columns])
    R = r.select(*[F.col(c).alias("r_" + c) for c in r.columns])
    rng = ((F.col("r_" + ts) >= F.col("p_" + ts) + interval(lower))
           & (F.col("r_" + ts) <= F.col("p_" + ts) + interval(upper)))
    same = F.col("p_" + key) == F.col("r_" + key)

    # pays one bucket, receipts every reachable pay bucket
    P1 = P.withColumn("_b1p", _bucket_secs(F.col("p_" + ts), w))
    rs = F.unix_seconds(F.col("r_" + ts))
    R1 = R.withColumn("_b1r", F.explode(F.sequence(F.floor((rs - hi) / w), F.floor((rs - lo) / w))))
    left = P1.join(R1, same & (F.col("_b1p") == F.col("_b1r")) & rng, "leftOuter")
    left = left.select(*P.columns, *R.columns).withColumn(
        "tag", F.when(F.col("r_" + key).isNull(), F.lit("unmatched_pay")).otherwise(F.lit("matched")))
    # receipts one bucket, pays every reachable receipt bucket: only the unmatched receipts
    R2 = R.withColumn("_b2r", _bucket_secs(F.col("r_" + ts), w))
    ps = F.unix_seconds(F.col("p_" + ts))
    P2 = P.withColumn("_b2p", F.explode(F.sequence(F.floor((ps + lo) / w), F.floor((ps + hi) / w))))
    right = R2.join(P2, same & (F.col("_b2r") == F.col("_b2p")) & rng, "leftOuter")
    right = (right.where(F.col("p_" + key).isNull()).select(*P.columns, *R.columns)
             .withColumn("tag", F.lit("unmatched_receipt")))
    return left.unionByName(right)
