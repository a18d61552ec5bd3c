"""Top-N per window (K1-K3) and newest value per key (A10, S4 state).

A rank filter over ``row_number`` is planned by Catalyst as a
``WindowGroupLimit``: a partial top-N runs before the shuffle, so a window
with many keys sends at most N rows per map task, never all of its keys.
Ties are broken by the key ascending (D3), which makes the answer total.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_n(df: DataFrame, group: list[str], order: list[Column], n: int,
          rank: str = "rank") -> DataFrame:
    """Keep the first ``n`` rows of each ``group`` under ``order``; add a 1-based rank (K3)."""
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= n)


def top_n_by_count(counts: DataFrame, n: int, key: str, count: str = "cnt",
                   window_end: str = "window_end", rank: str = "rank") -> DataFrame:
    """K1/K2: top ``n`` keys per window end by count descending, key ascending."""
    return top_n(counts, [window_end], [F.col(count).desc(), F.col(key).asc()], n, rank)


def newest_per_key(df: DataFrame, key: list[str], version: str, cols: list[str]) -> DataFrame:
    """The row with the greatest ``version`` per key (last write wins).

    ``max_by`` is an ordinary aggregate: partial per map task, then merged,
    so a key with many versions never gathers in one place.
    """
    payload = F.struct(*[F.col(c) for c in [version, *cols]])
    return (df.groupBy(*key).agg(F.max_by(payload, F.col(version)).alias("_v"))
            .select(*key, *[F.col(f"_v.{c}").alias(c) for c in [version, *cols]]))
