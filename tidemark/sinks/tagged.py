"""ST13: one stateful step, several outputs, each with its own sink.

A stream with side outputs is one DataFrame with a ``tag`` column.  Starting one query per output would run
the stateful step once for each.  :func:`tagged_writer` writes a micro-batch once, partitioned by tag, and
hands each tag's rows to its sink from there: the step runs once, a sink reads only its own folder,
and a replayed epoch hands the same rows again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tidemark.streaming import folders

Write = Callable[[DataFrame, int], None]


def tagged_writer(path: str, sinks: dict[str, Write], rest: Write | None = None, tag: str = "tag") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function; ``rest`` takes the rows of tags that have no sink (null included).

    The layout of an epoch stays until the one after next is done, so a failed epoch starts over from the
    same files; sinks must take an epoch twice without harm (as the writers of this package do)."""
    base = path.rstrip("/")

    def _write(df: DataFrame, epoch: int) -> None:
        spark, target = df.sparkSession, f"{base}/epoch={epoch}"
        if not folders.exists(spark, target):
            df.write.mode("overwrite").partitionBy(tag).parquet(target)
        plain = [f for f in df.schema.fields if f.name != tag]
        schema = type(df.schema)([*plain, df.schema[tag]])
        laid = spark.read.schema(schema).parquet(target)
        for name, write in sinks.items():
            write(laid.where(F.col(tag) == name).drop(tag), epoch)
        if rest is not None:
            rest(laid.where(F.col(tag).isNull() | ~F.col(tag).isin(*sinks)), epoch)
        folders.delete(spark, f"{base}/epoch={epoch - 2}")

    return _write
