"""A document sink with commit and abort, as a Python data source stream writer.

Tasks write bulk files (one action line ``{"index": {"_id": ...}}`` and one document line per row, the form a
search index loads) under ``<path>/staged``.  Nothing of a micro-batch is visible before its commit: the
driver then writes ``<path>/commits/<epoch>.json``, the list of the epoch's files, in one move.  A failed
epoch's files are deleted and were never listed; an epoch that runs again after its commit keeps the first
list.  Ids come from the key columns, so loading a file twice leaves one document each.

``path`` may be on any file system that pyarrow reaches (a mounted folder, HDFS, an object store); it must be
shared by the driver and the executors.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage

FORMAT = "tidemark_documents"
# Rows of one bulk file.
BULK_ROWS = 50_000


@dataclass
class Written(WriterCommitMessage):
    """Files of one task, relative to the sink's folder."""
    files: list[str]
    rows: int


class BulkWriter(DataSourceStreamWriter):
    def __init__(self, path: str, id_cols: list[str], bulk_rows: int = BULK_ROWS):
        self.path, self.id_cols, self.bulk_rows = path.rstrip("/"), id_cols, bulk_rows

    def _fs(self) -> tuple[fs.FileSystem, str]:
        return (fs.LocalFileSystem(), self.path) if "://" not in self.path and not self.path.startswith("file:") else fs.FileSystem.from_uri(self.path)

    def write(self, iterator: Iterator) -> Written:
        store, base = self._fs()
        store.create_dir(f"{base}/staged", recursive=True)
        files, out, n, total = [], None, 0, 0
        try:
            for row in iterator:
                if out is None or n >= self.bulk_rows:
                    if out is not None:
                        out.close()
                    files.append(f"staged/{uuid.uuid4().hex}.ndjson")
                    out, n = store.open_output_stream(f"{base}/{files[-1]}"), 0
                doc = row.asDict(recursive=True)
                key = "-".join(str(doc[c]) for c in self.id_cols if doc[c] is not None)
                out.write((json.dumps({"index": {"_id": key}}) + "\n" + json.dumps(doc, ensure_ascii=False, default=str) + "\n").encode())
                n, total = n + 1, total + 1
        finally:
            if out is not None:
                out.close()
        return Written(files, total)

    def commit(self, messages: list, batchId: int) -> None:
        store, base = self._fs()
        mine = [m for m in messages if m is not None]
        target = f"{base}/commits/{batchId}.json"
        if store.get_file_info(target).type != fs.FileType.NotFound:      # committed before: the first list stays
            return self._delete(mine)
        store.create_dir(f"{base}/commits", recursive=True)
        part = f"{base}/staged/{uuid.uuid4().hex}.commit"
        with store.open_output_stream(part) as out:
            out.write(json.dumps({"epoch": batchId, "rows": sum(m.rows for m in mine), "files": [f for m in mine for f in m.files]}).encode())
        store.move(part, target)

    def abort(self, messages: list, batchId: int) -> None:
        self._delete([m for m in messages if m is not None])

    def _delete(self, messages: list) -> None:
        store, base = self._fs()
        for f in (f for m in messages for f in m.files):
            store.delete_file(f"{base}/{f}")


class DocumentSink(DataSource):
    """``writeStream.format("tidemark_documents")`` with options ``path`` and ``id`` (key columns, comma-separated)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def streamWriter(self, schema, overwrite: bool) -> BulkWriter:
        ids = [c.strip() for c in self.options.get("id", "").split(",") if c.strip()]
        if not self.options.get("path") or not ids or not set(ids) <= set(schema.fieldNames()):
            raise ValueError(f"give a path and id columns among {schema.fieldNames()}")
        return BulkWriter(self.options["path"], ids, int(self.options.get("bulkRows", BULK_ROWS)))


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(DocumentSink)


def committed(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, id, doc) of all committed documents, read in parallel; staged files of failed epochs are not seen."""
    base = path.rstrip("/")
    lists = spark.read.option("multiLine", True).schema("epoch LONG, rows LONG, files ARRAY<STRING>").json(f"{base}/commits")
    files = lists.select("epoch", F.explode("files").alias("file")).withColumn("name", F.substring_index("file", "/", -1))
    # an action line and its document stand next to each other: wholetext keeps them together, one bulk file a row
    texts = spark.read.text(f"{base}/staged", wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value")
    lines = texts.join(files, "name").select("epoch", F.posexplode(F.split("value", "\n")).alias("at", "line"), "name")
    pairs = lines.where("line <> ''").groupBy("epoch", "name", F.floor(F.col("at") / 2).alias("k")).agg(
        F.min(F.when(F.col("at") % 2 == 0, F.get_json_object("line", "$.index._id"))).alias("id"),
        F.min(F.when(F.col("at") % 2 == 1, F.col("line"))).alias("doc"))
    return pairs.select("epoch", "id", "doc")
