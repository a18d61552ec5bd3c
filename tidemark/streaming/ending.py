"""The end of a bounded input on a stream.

Spark closes a window or fires a timer only when the watermark passes it, so the last ones of a finished
input stay open.  An :class:`Ending` adds one closing row per input, after all others, whose time lies past
every window, timer and limit: it moves the watermark to the end of time (``functions.eventtime.watermark``
takes it out again right above), and what was open comes out exactly as in the batch form.

The closing row is a file in a folder of its own, read as a second source of the same query, so it works
for any source; with two inputs each attaches its own and the slower watermark still governs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.eventtime import END, as_watermarkable
from tidemark.streaming import folders
from tidemark.streaming.runner import start

# 9000-01-01 UTC: past every event, with room for limits to be added.
END_MS = 221_845_392_000_000


class Ending:
    """The end of the inputs of one query; ``folder`` must be shared and new for each query."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        folders.make(spark, self.folder)

    def attach(self, df: DataFrame, ts: str = "ts") -> DataFrame:
        """``df`` with its closing row to come (column ``_end``); event time is assigned after this."""
        closing = (self.spark.readStream.schema("ends_ms LONG").json(self.folder)
                   .select(F.timestamp_millis("ends_ms").alias(ts), F.lit(True).alias(END)))
        return as_watermarkable(df, ts).withColumn(END, F.lit(False)).unionByName(closing, allowMissingColumns=True)

    def close(self) -> None:
        """Say that no more input comes; a running or the next run of the query ends its windows."""
        if not folders.exists(self.spark, self.folder):
            self.spark.createDataFrame([(END_MS,)], "ends_ms LONG").coalesce(1).write.mode("append").json(self.folder)


def run_to_end(df: DataFrame, name: str, end: Ending, checkpoint: str, **kw) -> None:
    """Process all input, then the closing row, in one run: every window, timer and limit has come out afterwards.

    The row is written only when the input there is has been taken, since rows that come with it or after
    it would be late.  Takes the sink arguments of :func:`~tidemark.streaming.runner.run_available`."""
    query = start(df, name, checkpoint=checkpoint, **kw)
    try:
        query.processAllAvailable()
        end.close()
        query.processAllAvailable()
    finally:
        query.stop()
