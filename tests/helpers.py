"""Small builders for hand-made fixtures (times in seconds after 2024-01-01 UTC)."""

from pyspark.sql import functions as F

BASE = 1704067200  # 2024-01-01 00:00:00 UTC


def frame(spark, rows, cols, ts_col="t", millis=False):
    """Rows -> DataFrame with a TIMESTAMP ``ts`` from offset column ``ts_col`` and ``seq`` = row order."""
    data = [tuple(r) + (i,) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, list(cols) + ["seq"])
    if millis:
        ts = F.timestamp_millis((F.lit(BASE * 1000) + F.col(ts_col)).cast("long"))
    else:
        ts = F.timestamp_seconds((F.lit(BASE) + F.col(ts_col)).cast("long"))
    return df.withColumn("ts", ts).drop(ts_col)


def secs(col="ts"):
    """TIMESTAMP column -> seconds after BASE (for assertions)."""
    return (F.unix_micros(F.col(col)) / 1_000_000 - BASE)
