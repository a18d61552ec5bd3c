"""K2: top N per window kept up to date incrementally, emitting rank changes.

The current counts are a table partitioned by window.  A micro-batch brings changed counts; only the
windows they belong to are read, merged, ranked again and written as a new version
(``window_ms=<w>/epoch=<e>``).  The rows whose rank, key or count changed go to the caller's writer.  A version
holds its window whole, so a replayed epoch reads the versions before it and writes the same again; a
window's version before last goes away when a new one is written.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.operators import topn
from tidemark.streaming import folders


def _schema(df: DataFrame, key: str, count: str) -> str:
    return f"window_start TIMESTAMP, window_end TIMESTAMP, `{key}` {df.schema[key].dataType.simpleString()}, `{count}` LONG"


def touched_versions(spark, path: str, schema: str, versions: dict[int, int]) -> DataFrame:
    """The given version (epoch) of each given window: only their folders are listed, and the filter on the
    partition columns reads nothing else."""
    if not versions:
        return spark.createDataFrame([], f"{schema}, window_ms LONG, epoch LONG")
    there = (spark.read.schema(f"{schema}, window_ms LONG, epoch LONG").option("basePath", path)
             .parquet(*[f"{path}/window_ms={w}" for w in versions]))
    wanted = F.lit(False)
    for epoch in sorted(set(versions.values())):
        wanted = wanted | ((F.col("epoch") == epoch) & F.col("window_ms").isin([w for w, e in versions.items() if e == epoch]))
    return there.where(wanted)


def rank_changes_writer(path: str, n: int, key: str, write: Callable[[DataFrame, int], None], count: str = "cnt") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over changed counts (window_start, window_end, key, count): keeps the table under
    ``path`` and hands (epoch, window_start, window_end, rank, key, count) of every changed rank to ``write``.

    Of several counts for one (window, key) in a micro-batch the largest is current (counts only grow); rows
    with a null count (late ones) are left out."""
    path = path.rstrip("/")
    columns = ["window_start", "window_end", "rank", key, count]

    def _batch(df: DataFrame, epoch: int) -> None:
        spark, schema = df.sparkSession, _schema(df, key, count)
        new = (df.where(F.col(count).isNotNull())
               .groupBy(F.col("window_start").cast("timestamp"), F.col("window_end").cast("timestamp"), key).agg(F.max(count).alias(count))
               .withColumn("window_ms", F.unix_millis("window_end")).persist())      # two passes read it
        try:
            windows = sorted(r[0] for r in new.select("window_ms").distinct().collect())   # those of one micro-batch
            older = {w: [e for e in folders.numbered(spark, f"{path}/window_ms={w}", "epoch") if e < epoch] for w in windows}
            before = touched_versions(spark, path, schema, {w: es[-1] for w, es in older.items() if es}).drop("epoch")
            merged = before.unionByName(new).groupBy("window_ms", "window_start", "window_end", key).agg(F.max(count).alias(count))
            (merged.withColumn("epoch", F.lit(epoch).cast("long")).repartition("window_ms").write.mode("overwrite")
             .option("partitionOverwriteMode", "dynamic").partitionBy("window_ms", "epoch").parquet(path))
            now = touched_versions(spark, path, schema, dict.fromkeys(windows, epoch))
            old, cur = (topn.top_n_by_count(t, n, key, count).select(*columns) for t in (before, now))
            write(cur.exceptAll(old).select(F.lit(epoch).cast("long").alias("epoch"), *columns), epoch)
            for w, es in older.items():
                for e in es[:-1]:
                    folders.delete(spark, f"{path}/window_ms={w}/epoch={e}")
        finally:
            new.unpersist()

    return _batch


def current_top_n(spark, path: str, n: int, key: str, count: str = "cnt") -> DataFrame:
    """The current top ``n`` of every window of the table."""
    whole = spark.read.parquet(path)
    newest = whole.groupBy("window_ms").agg(F.max("epoch").alias("epoch"))
    return topn.top_n_by_count(whole.join(newest, ["window_ms", "epoch"]).drop("window_ms", "epoch"), n, key, count)
