"""Documents are visible after their commit only, whatever fails or runs again."""

import glob
import json
import os
import tempfile

import pytest
from pyspark.sql import Row

from tidemark.sinks import bulk

DOCS = [Row(w="10:00", rank=1, item="é"), Row(w="10:00", rank=2, item=None), Row(w=None, rank=3, item="x\ny")]


def _seen(spark, path):
    return sorted((r["epoch"], r["id"], json.loads(r["doc"])["item"]) for r in bulk.committed(spark, path).collect())


def test_commit_abort_and_replay(spark):
    d = tempfile.mkdtemp(prefix="tidemark-bulk-")
    w = bulk.BulkWriter(d, ["w", "rank"], bulk_rows=2)
    first, failed = w.write(iter(DOCS)), w.write(iter(DOCS[:1]))
    assert len(first.files) == 2 and first.rows == 3 and not os.path.exists(f"{d}/commits")
    w.abort([failed, None], 0)
    assert sorted(glob.glob(f"{d}/staged/*")) == sorted(f"{d}/{f}" for f in first.files)
    w.commit([first, None], 0)
    want = [(0, "10:00-1", "é"), (0, "10:00-2", None), (0, "3", "x\ny")]
    assert _seen(spark, d) == want
    again = w.write(iter(DOCS))                                     # the epoch runs again after its commit
    assert _seen(spark, d) == want
    w.commit([again], 0)
    assert _seen(spark, d) == want and len(glob.glob(f"{d}/staged/*.ndjson")) == 2
    lost = w.write(iter(DOCS))                                      # a driver lost before the commit leaves files, not documents
    assert lost.rows == 3 and _seen(spark, d) == want
    w.commit([w.write(iter([]))], 1)
    assert _seen(spark, d) == want


def test_stream_into_documents(spark):
    bulk.register(spark)
    d, src = tempfile.mkdtemp(prefix="tidemark-bulk-"), tempfile.mkdtemp(prefix="tidemark-src-")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "concat('item ', id) AS item").coalesce(1).write.parquet(f"{src}/p={i}")
    stream = spark.readStream.schema("id long, item string").option("maxFilesPerTrigger", 1).parquet(f"{src}/p=*")
    q = (stream.writeStream.format(bulk.FORMAT).option("path", d).option("id", "id").option("checkpointLocation", tempfile.mkdtemp())
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = _seen(spark, d)
    assert sorted(int(k) for _, k, _ in got) == list(range(30)) and {e for e, _, _ in got} == {0, 1, 2}


def test_options_are_checked(spark):
    class Opts(bulk.DocumentSink):
        pass

    schema = spark.range(1).schema
    for options in ({}, {"path": "/x"}, {"path": "/x", "id": "absent"}):
        with pytest.raises(ValueError):
            Opts(options).streamWriter(schema, False)
