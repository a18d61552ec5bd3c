"""S1 text-file source and S2 Kafka source, batch or stream.

Both yield one ``value`` string column plus ``seq``, a tie-break for rows with equal event times (C7).

Tie rule of files: lines of one file go in line order; lines of different files go by a hash of the
file's name (its name only: moving or renaming the folder changes nothing), then by position.  ``seq`` packs
(hash of the name, place of the split in the file, row in the task), so neither a shuffle nor a second
pass is needed and batch and stream agree.  :func:`read_numbered_lines` gives exact line numbers instead.
Kafka rows get partition and offset packed into one number, unique in the topic.  Kafka needs the
connector jar on the cluster's classpath; it is not bundled here, so only the reader options are set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# A Kafka offset takes the low 48 bits of ``seq``, the partition the bits above.
OFFSET_BITS = 48
# seq of a line: 9 bits of the file name's hash, 26 bits split offset in units of 64 KiB (files up to
# 4 TiB; splits are far larger than the unit), 28 bits row in the task.
_NAME_BITS, _SPLIT_BITS, _ROW_BITS, _UNIT_BITS = 9, 26, 28, 16


def _place() -> Column:
    """The part of ``seq`` that a split has: its file's name, its place in the file."""
    name = F.pmod(F.xxhash64(F.col("_metadata.file_name")), F.lit(1 << _NAME_BITS))
    split = F.pmod(F.shiftright(F.col("_metadata.file_block_start"), _UNIT_BITS), F.lit(1 << _SPLIT_BITS))
    return F.shiftleft(name, _SPLIT_BITS + _ROW_BITS) + F.shiftleft(split, _ROW_BITS)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the row's number in the task to its place: what monotonically_increasing_id() does, which streams
    refuse.  Whole Arrow batches, no row is looked at."""
    n = 0
    for b in batches:
        row = np.arange(n, n + b.num_rows) % (1 << _ROW_BITS)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(b.column(1).to_numpy(zero_copy_only=False) + row)], names=["value", "seq"])
        n += b.num_rows


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of text files.  In a stream each new file is new input."""
    r = (spark.readStream if stream else spark.read).format("text")
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = r.load(path)
    if stream:
        return lines.select("value", _place().alias("seq")).mapInArrow(_count_rows, "value string, seq long")
    # rows of one split stand in one task, in file order
    return lines.select("value", (_place() + F.pmod(F.monotonically_increasing_id(), F.lit(1 << _ROW_BITS))).alias("seq"))


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines (file, line_no, value) of text files in batch, numbered from 0 in each file.

    Rows are counted per split (partial sums), the counts summed up per file over its splits, and a line's
    number is that offset plus its place in the split: only the small table of splits is ever ordered."""
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_split"),
                                       F.monotonically_increasing_id().alias("_at"), "value")
    splits = raw.groupBy("file", "_split").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "_split", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (raw.join(offsets, ["file", "_split"])
            .select("file", (F.col("_before") + F.col("_at") - F.col("_first")).alias("line_no"), "value"))


def read_kafka(spark: SparkSession, bootstrap: str, topic: str, stream: bool = True,
               starting_offsets: str = "latest", group_id: str | None = None,
               extra: dict | None = None) -> DataFrame:
    """String messages of one topic, starting at ``latest`` as in the reference."""
    r = (spark.readStream if stream else spark.read).format("kafka")
    r = r.option("kafka.bootstrap.servers", bootstrap).option("subscribe", topic)
    r = r.option("startingOffsets", starting_offsets if stream else "earliest")
    if group_id:
        r = r.option("kafka.group.id", group_id)
    for k, v in (extra or {}).items():
        r = r.option(k, v)
    return r.load().select(F.col("value").cast("string").alias("value"), "timestamp",
                           (F.shiftleft(F.col("partition").cast("long"), OFFSET_BITS) + F.col("offset")).alias("seq"))
