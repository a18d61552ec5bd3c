"""S6 as a source: the keyed store of a stateful stream read as a table.

The reference asks its store for the users it has seen.  Here that store is the stream's own state; Spark's
state data source reads a committed version of it from the checkpoint, running stream or not, by state
variable and batch, one partition per store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """Rows (key, value or map entry, partition_id) of one state variable, after ``batch`` (default: the last)."""
    r = (spark.read.format("statestore").option("operatorId", str(operator)).option("stateVarName", variable))
    return (r if batch is None else r.option("batchId", str(batch))).load(checkpoint)


def seen_users(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """(window_end, user) pairs that ``distinct.first_sightings`` holds for its open windows."""
    s = read_state(spark, checkpoint, "seen", operator, batch)
    return s.select(F.timestamp_millis("key.window_end_ms").alias("window_end"), F.col("key.user").alias("user"))


def open_window_visitors(spark: SparkSession, checkpoint: str, operator: int = 0, batch: int | None = None) -> DataFrame:
    """Distinct users so far of every open window."""
    return seen_users(spark, checkpoint, operator, batch).groupBy("window_end").agg(F.count(F.lit(1)).alias("uv"))
