"""A table laid out in one global order, so that scans and ranks of a key need not gather it in one task.

:func:`lay_out` range-partitions rows by an order, sorts each partition and writes the result to the
shared folder.  A key with a third of all rows then spans a third of the partitions.  What a scan needs
from other partitions is a summary of each (key, partition) run: one small row, combined in order of the
partitions (:func:`runs`, :func:`positions`; :mod:`tidemark.operators.carry` scans with it).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.session import ensure_checkpoint_dir

# monotonically_increasing_id() holds the partition above this bit, the row in the partition below.
_ROW_BITS = 33
PART, ROW = "_part", "_row"


def lay_out(df: DataFrame, by: list[str | Column], name: str) -> DataFrame:
    """``df`` in the global order ``by`` with ``_part`` (partitions ascend in that order) and ``_row``
    (order inside the partition).

    Rows equal in ``by`` stay in one partition: end ``by`` with a column that tells rows apart where many
    may tie.  ``df`` is read twice (the range bounds are sampled first).  The table is written, so its
    numbers stay the same when a lost task runs again.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tidemark-layout/{name}-{uuid.uuid4().hex}"
    laid = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    laid.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(laid.schema).parquet(path)
    return (back.withColumn(PART, F.shiftright("_at", _ROW_BITS)).withColumn(ROW, F.col("_at") % F.lit(1 << _ROW_BITS))
            .drop("_at"))


def runs(laid: DataFrame, keys: list[str], *summaries: Column) -> DataFrame:
    """One row per key and partition: where its run begins (``_first``), its rows (``_n``) and ``summaries``."""
    return laid.groupBy(*keys, PART).agg(F.min(ROW).alias("_first"), F.count(F.lit(1)).alias("_n"), *summaries)


def with_runs(laid: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """Join a table of one row per (keys, ``_part``) back to the rows, null keys included.

    A key's rows meet their run by partition, so a hot key is spread as the layout spread it.  Spark
    broadcasts the runs if their measured size allows."""
    right = small.select(*[F.col(c).alias(f"_k_{i}") for i, c in enumerate([*keys, PART])],
                         *[c for c in small.columns if c not in (*keys, PART)])
    cond = F.lit(True)
    for i, c in enumerate([*keys, PART]):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_k_{i}"))
    return laid.join(right, cond).drop(*[f"_k_{i}" for i in range(len(keys) + 1)])


def positions(laid: DataFrame, keys: list[str], out: str = "pos", total: str = "n") -> DataFrame:
    """Add each row's position in its key (from 0, in layout order) and the key's row count.

    Per key the windows run over one row per partition, never over the rows."""
    per_key = Window.partitionBy(*keys)
    before = per_key.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    small = runs(laid, keys).select(*keys, PART, "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                                    F.sum("_n").over(per_key).alias(total))
    return (with_runs(laid, small, keys).withColumn(out, F.col("_before") + F.col(ROW) - F.col("_first"))
            .drop("_before", "_first", PART, ROW))
