"""Matching two keyed event streams (J1-J4): pays against receipts.

* J1 ``interval_join``: all pairs with the same key and
  right.ts in [left.ts + lower, left.ts + upper], both ends included.
* J2 ``one_to_one``: the k-th left row of a key pairs with the k-th right
  row (both ordered by time, then tie-breaks); a pair counts when it lies in
  the interval.  Every row ends up matched or unmatched (D15, D16).
* J3/J4 unmatched rows on either side, for both forms.

Spark chooses the physical join.  Interval joins of two sides whose keys repeat
add a time bucket to the equi-join key (range-join bucketing), so a hot key is
split by time and never compared pairwise as a whole; ``spread`` names the
side that is copied into the buckets its range reaches (the narrow one).  When
the left key is unique (a primary key) a right row meets one left row at most:
no bucket and no copy is needed, and adaptive execution splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.eventtime import interval
from tidemark.operators.ordered import running_sum
from tidemark.operators.windows import seconds

# Ranks of a side whose key repeats: wide enough that a (key, bucket) group holds many rows.
RANK_BUCKET = "1 day"


def _in_interval(l_ts: Column, r_ts: Column, lower: str, upper: str) -> Column:
    return (r_ts >= l_ts + interval(lower)) & (r_ts <= l_ts + interval(upper))


def _prefixed(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def _signed_seconds(d: str) -> int:
    d = d.strip()
    return -seconds(d[1:]) if d.startswith("-") else seconds(d)


def _negated(d: str) -> str:
    return d.strip()[1:] if d.strip().startswith("-") else "-" + d.strip()


def _buckets(one: DataFrame, many: DataFrame, one_ts: str, many_ts: str, lower: str, upper: str,
             width: int | None) -> tuple[DataFrame, DataFrame]:
    """Range-join bucketing: a row of ``one`` gets its time bucket, a row of ``many`` every
    bucket its range can reach (at most 2 when width = upper - lower; the range is
    [lower, upper] from ``one`` to ``many``).  Each matching pair meets in exactly one bucket."""
    lo, hi = _signed_seconds(lower), _signed_seconds(upper)
    w = width or max(hi - lo, 1)
    sec = F.unix_timestamp(F.col(many_ts))
    return (one.withColumn("_b", F.floor(F.unix_timestamp(F.col(one_ts)) / w)),
            many.withColumn("_rb", F.explode(F.sequence(F.floor((sec - hi) / w), F.floor((sec - lo) / w)))))


def _sides(L: DataFrame, R: DataFrame, l_ts: str, r_ts: str, lower: str, upper: str, width: int | None,
           left_unique: bool, spread: str) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides and the bucket part of the join condition."""
    if left_unique:
        return L, R, F.lit(True)
    if spread == "right":
        L, R = _buckets(L, R, l_ts, r_ts, lower, upper, width)
    elif spread == "left":
        R, L = _buckets(R, L, r_ts, l_ts, _negated(upper), _negated(lower), width)
    else:
        raise ValueError("spread is 'left' or 'right'")
    return L, R, F.col("_b") == F.col("_rb")


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """``df``, if no two of its rows share a (non-null) ``key``; else ``ValueError`` naming one that they do.

    One aggregation of the keys.  Call it once where a table's key is not known to be unique, before
    ``left_unique=True``: that promise is taken as given, and a repeated key would give wrong pairs."""
    twice = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{key} is not unique: {twice[0][0]!r} comes {twice[0][1]} times")
    return df


def interval_join(left: DataFrame, right: DataFrame, key: str, lower: str, upper: str,
                  ts: str = "ts", lp: str = "p_", rp: str = "r_", width: int | None = None,
                  left_unique: bool = False, spread: str = "right") -> DataFrame:
    """Inner interval join; columns are prefixed ``lp`` / ``rp``.  ``left_unique`` promises that no left key
    repeats (see :func:`require_unique`)."""
    L, R, met = _sides(_prefixed(left, lp), _prefixed(right, rp), lp + ts, rp + ts, lower, upper, width, left_unique, spread)
    cond = ((F.col(lp + key) == F.col(rp + key)) & met
            & _in_interval(F.col(lp + ts), F.col(rp + ts), lower, upper))
    return L.join(R, cond, "inner").drop("_b", "_rb")


def unmatched_left(left: DataFrame, right: DataFrame, key: str, lower: str, upper: str,
                   ts: str = "ts", width: int | None = None, left_unique: bool = False) -> DataFrame:
    """J3 (interval form): left rows with no right row of the key in the interval."""
    L, R, met = _sides(left, _prefixed(right.select(key, ts), "_r"), ts, "_r" + ts, lower, upper, width, left_unique, "right")
    cond = (L[key] == F.col("_r" + key)) & met & _in_interval(L[ts], F.col("_r" + ts), lower, upper)
    return L.join(R, cond, "left_anti").drop("_b")


def unmatched_right(left: DataFrame, right: DataFrame, key: str, lower: str, upper: str,
                    ts: str = "ts", width: int | None = None, left_unique: bool = False) -> DataFrame:
    """J4 (interval form): right rows with no left row of the key in the interval.

    Mirrored: the right row keeps one bucket, the left rows go to every bucket their
    range reaches (the interval seen from the right is [-upper, -lower])."""
    L, R, met = _sides(_prefixed(left.select(key, ts), "_l"), right, "_l" + ts, ts, lower, upper, width, left_unique, "left")
    cond = (R[key] == F.col("_l" + key)) & met & _in_interval(F.col("_l" + ts), R[ts], lower, upper)
    return R.join(L, cond, "left_anti").drop("_b")


def one_to_one(left: DataFrame, right: DataFrame, key: str, lower: str, upper: str, ts: str = "ts",
               left_order: list[str] | None = None, right_order: list[str] | None = None,
               lp: str = "p_", rp: str = "r_", bucket: str = RANK_BUCKET,
               left_unique: bool = False, right_unique: bool = False) -> dict[str, DataFrame]:
    """K-th pairing.  Returns ``matched``, ``unmatched_left``, ``unmatched_right``.

    ``left_order`` / ``right_order`` must make the order within a key total
    (time first); they decide which row is the k-th.  With a unique left key
    (``left_unique``, e.g. a primary key) only the first right row of a key can
    pair: a minimum per key, partial before its shuffle, replaces the ranking.
    """
    lo, ro = left_order or [ts], right_order or [ts]
    inside = _in_interval(F.col(lp + ts), F.col(rp + ts), lower, upper)
    if left_unique:
        rest = [c for c in right.columns if c not in (key, *ro)]
        first = (right.groupBy(key).agg(F.min(F.struct(*ro, *rest)).alias("_first"))
                 .select(F.col(key).alias(rp + key), *[F.col(f"_first.{c}").alias(rp + c) for c in (*ro, *rest)]))
        L, R = _prefixed(left, lp), first.select(*[rp + c for c in right.columns])
        matched = L.join(R, (F.col(lp + key) == F.col(rp + key)) & inside, "inner")
        taken = matched.select(*[F.col(rp + c) for c in (key, *ro)])
        same = F.lit(True)
        for c in (key, *ro):
            same = same & right[c].eqNullSafe(F.col(rp + c))
        return {"matched": matched,
                "unmatched_left": _bare(L.join(R, (F.col(lp + key) == F.col(rp + key)) & inside, "left_anti"), lp),
                "unmatched_right": right.join(taken, same, "left_anti")}
    rank = lambda df, order, unique: (df.withColumn("_k", F.lit(1).cast("long")) if unique
                                      else running_sum(df, [key], order, F.lit(1), "_k", bucket))
    L, R = _prefixed(rank(left, lo, False), lp), _prefixed(rank(right, ro, right_unique), rp)
    cond = (F.col(lp + key) == F.col(rp + key)) & (F.col(lp + "_k") == F.col(rp + "_k")) & inside
    matched = L.join(R, cond, "inner").drop(lp + "_k", rp + "_k")
    # A row is unmatched exactly when the same (key, k) on the other side is
    # missing or out of range: one anti-join per side, no pair set needed.
    return {"matched": matched,
            "unmatched_left": _bare(L.join(R, cond, "left_anti").drop(lp + "_k"), lp),
            "unmatched_right": _bare(R.join(L, cond, "left_anti").drop(rp + "_k"), rp)}


def _bare(df: DataFrame, prefix: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c[len(prefix):]) for c in df.columns])
