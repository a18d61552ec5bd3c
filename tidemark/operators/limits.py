"""Click cap per (user, ad, day) with a one-time warning (ST1-ST3, F5).

Batch form: rank clicks per (user, ad, UTC day of the event) and keep ranks
1..cap; rank cap+1 is the blacklist warning.  The rank filter is planned as
a partial ``WindowGroupLimit`` before the shuffle, so at most cap+1 rows of a
hot (user, ad, day) leave each map task.  The day is the event's UTC day
(D7), so a replay gives the same answer as the live run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Fixed text of the reference's warning; the number is the cap.
WARNING_TEXT = "Click over {cap} times today."


def _ranked(df: DataFrame, cap: int, keys: list[str], ts: str, seq: str) -> DataFrame:
    w = Window.partitionBy(*keys, "day").orderBy(ts, seq)
    return (df.withColumn("day", F.to_date(ts))
            .withColumn("_rank", F.row_number().over(w))
            .where(F.col("_rank") <= cap + 1))


def capped_clicks(df: DataFrame, cap: int, keys: list[str] = ("user_id", "ad_id"),
                  ts: str = "ts", seq: str = "seq") -> DataFrame:
    """ST1: the clicks that pass the cap (the first ``cap`` per key and day)."""
    return _ranked(df, cap, list(keys), ts, seq).where(F.col("_rank") <= cap).drop("_rank")


def blacklist_warnings(df: DataFrame, cap: int, keys: list[str] = ("user_id", "ad_id"),
                       ts: str = "ts", seq: str = "seq") -> DataFrame:
    """ST2: one warning per key and day, at the first click over the cap."""
    keys = list(keys)
    return (_ranked(df, cap, keys, ts, seq).where(F.col("_rank") == cap + 1)
            .select(*keys, "day", F.col(ts).alias("ts"),
                    F.lit(WARNING_TEXT.format(cap=cap)).alias("msg")))
