"""Session helpers.

On a cluster the session is created by the platform; :func:`ensure_checkpoint_dir`
only fills ``spark.checkpoint.dir`` when the cluster left it unset (tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job in this package assumes.  UTC keeps text times and day
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Settings for a large cluster (order of 1000 executors, ~100 TB of input).
# Apply with :func:`tune_for_cluster`; nothing here is forced on a session.
CLUSTER_CONF = {
    # Start wide and let adaptive execution merge small partitions to ~256 MB.
    "spark.sql.shuffle.partitions": "16384",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    # Split skewed join partitions (hot keys) at run time.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    # Scan splits sized to fit an executor core's memory comfortably.
    "spark.sql.files.maxPartitionBytes": "512m",
    # Broadcast only what is measured small; no broadcast is placed by hand.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    # Streams: RocksDB state with changelog checkpoints (small incremental uploads).
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


# Streams: every shuffle partition is a state store per stateful operator, committed each
# micro-batch, so a stream takes a few per core of its own executors, not a batch job's count.
STREAM_CONF = {"spark.sql.shuffle.partitions": "512"}


def tune_for_cluster(spark: SparkSession, overrides: dict | None = None, streaming: bool = False) -> dict:
    """Apply :data:`CLUSTER_CONF` (for streams :data:`STREAM_CONF` on top, then ``overrides``) to a
    session; returns what was set.

    The shuffle partition count of a streaming query is fixed at its first
    start (it sizes the state store), so set it before starting streams.
    """
    conf = {**CLUSTER_CONF, **(STREAM_CONF if streaming else {})}
    conf.update(overrides or {})
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tidemark", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf["spark.driver.memory"] = os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; set a scratch one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that value is
    always respected.  Only a local session without one gets a fresh temp dir;
    on a cluster an unset folder is an error, as executors share no local disk.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """A per-query streaming checkpoint location under the shared folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/streams/{name}"
