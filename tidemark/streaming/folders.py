"""Folders of per-epoch output in the shared file system: existence, removal, folding.

A log written once per micro-batch would grow by a folder each time.  :func:`fold`
merges ``RADIX`` folders of one level into one of the next as soon as they are
complete, so after N epochs at most RADIX folders per level are left, log(N) in
total; which folders exist follows from the epoch number, nothing is listed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

RADIX = 8


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a completely written folder is there."""
    fs, p = _path(spark, f"{path}/_SUCCESS")
    return fs.exists(p)


def make(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.mkdirs(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


def numbered(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders ``<name>=<number>`` right under ``path``, ascending."""
    fs, p = _path(spark, path)
    if not fs.exists(p):
        return []
    found = (s.getPath().getName() for s in fs.listStatus(p))
    return sorted(int(f.split("=", 1)[1]) for f in found if f.startswith(f"{name}="))


def epoch_folder(path: str, level: int, epoch: int) -> str:
    """Holds the RADIX ** level epochs up to ``epoch``."""
    return f"{path.rstrip('/')}/level={level}/upto={epoch}"


def fold(spark: SparkSession, path: str, epoch: int, merge: Callable[[DataFrame], DataFrame]) -> None:
    """Merge complete runs of folders that end at ``epoch``; a replayed epoch changes nothing."""
    level, span = 1, RADIX
    while (epoch + 1) % span == 0:
        target = epoch_folder(path, level, epoch)
        parts = [epoch_folder(path, level - 1, epoch - span // RADIX * k) for k in range(RADIX)]
        if not exists(spark, target):
            there = [p for p in parts if exists(spark, p)]
            if there:
                merge(spark.read.parquet(*there)).write.mode("overwrite").parquet(target)
        for p in parts:
            delete(spark, p)
        level, span = level + 1, span * RADIX
