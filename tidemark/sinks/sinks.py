"""Sinks of the reference's jobs, re-expressed for Spark.

* S3 console with a tag: ``writeStream.format('console')`` named by the tag.
* S4 SQL upsert: per micro-batch keep the newest row per key, write it to a
  staging table through Spark's JDBC writer (executors write in parallel),
  then one MERGE statement on the database.  No row-at-a-time statements.
* S5 document index: one JSON document per row with a stable id, written as
  NDJSON (the index connector is not available offline; the format is an
  option).
* S7 topic lines: a record encoded as a delimited line or a JSON object.
* K4 report text: the "Time / NoK" report built from typed top-N rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.formatting import encode_json, encode_line, text_time_millis
from tidemark.operators.topn import newest_per_key


def console(df: DataFrame, tag: str, mode: str = "append", truncate: bool = False):
    """S3: a streaming console sink named after the reference's print tag."""
    return (df.writeStream.format("console").queryName(tag).outputMode(mode)
            .option("truncate", str(truncate).lower()))


def report_text(top: DataFrame, key: str, count: str, window_end: str = "window_end",
                rank: str = "rank", key_label: str = "item", count_label: str = "views") -> DataFrame:
    """K4: one text report per window from typed top-N rows (rank order kept).

    The per-window array holds at most N entries (the input is already cut
    to the top N), so the collect is bounded by N, not by the data.
    """
    entry = F.struct(F.col(rank).alias("r"), F.col(key).alias("k"), F.col(count).alias("c"))
    lines = F.transform(
        F.array_sort(F.collect_list(entry)),
        lambda e: F.format_string(f"No%d: {key_label}=%s {count_label}=%d", e["r"], e["k"].cast("string"), e["c"]))
    return (top.groupBy(window_end)
            .agg(F.concat(F.lit("Time: "), text_time_millis(F.first(window_end)), F.lit("\n"),
                          F.array_join(lines, "\n")).alias("report")))


def upsert_rows(df: DataFrame, key: list[str], version: str, cols: list[str]) -> DataFrame:
    """S4 state: what the upsert table holds after this batch (newest version per key, D21)."""
    return newest_per_key(df, key, version, cols)


def merge_statement(table: str, stage: str, key: list[str], version: str, cols: list[str]) -> str:
    """One MERGE from the staging table; the stored row wins when it is newer."""
    names = [*key, version, *cols]
    on = " AND ".join(f"t.{k} = s.{k}" for k in key)
    sets = ", ".join(f"{c} = s.{c}" for c in [version, *cols])
    return (f"MERGE INTO {table} t USING {stage} s ON {on} "
            f"WHEN MATCHED AND s.{version} >= t.{version} THEN UPDATE SET {sets} "
            f"WHEN NOT MATCHED THEN INSERT ({', '.join(names)}) "
            f"VALUES ({', '.join('s.' + n for n in names)})")


def stage_table(table: str, query_id: str | None, epoch: int) -> str:
    """The staging table of a micro-batch.  The id is the checkpoint's, so a restarted query writes over what a
    crash left, and two queries never share a table."""
    return f"{table}_stage_{(query_id or 'batch').replace('-', '')[:12]}_{epoch}"


def jdbc_upsert_writer(url: str, table: str, key: list[str], version: str, cols: list[str],
                       properties: dict | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer doing staging write + one MERGE per micro-batch.

    Executors write the staging table in parallel through Spark's JDBC writer;
    the driver sends one MERGE statement (metadata, not data) and drops the
    staging table.  Credentials
    come from ``properties`` (D20).  Replays are idempotent: the MERGE keeps
    the stored row when it is newer than the incoming one.
    """
    props = dict(properties or {})

    def _write(df: DataFrame, epoch_id: int) -> None:
        staged = upsert_rows(df, key, version, cols)
        stage = stage_table(table, df.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId"), epoch_id)
        staged.write.jdbc(url, stage, mode="overwrite", properties=props)
        merge = merge_statement(table, stage, key, version, cols)
        jvm = df.sparkSession.sparkContext._jvm
        jprops = jvm.java.util.Properties()
        for k, v in props.items():
            jprops.setProperty(k, str(v))
        conn = jvm.java.sql.DriverManager.getConnection(url, jprops)
        try:
            stmt = conn.createStatement()
            try:
                stmt.executeUpdate(merge)
                stmt.executeUpdate(f"DROP TABLE {stage}")
            finally:
                stmt.close()
        finally:
            conn.close()
    return _write


def documents(df: DataFrame, id_cols: list[str], cols: list[str]) -> DataFrame:
    """One document per row: ``id`` (key columns joined by '-') and a JSON body."""
    return df.select(_document_id(id_cols), encode_json(*cols).alias("doc"))


def _document_id(id_cols: list[str]) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in id_cols]).alias("id")


def document_writer(path: str, id_cols: list[str], cols: list[str],
                    fmt: str = "json") -> Callable[[DataFrame, int], None]:
    """S5 ``foreachBatch`` writer: NDJSON per epoch; a replayed epoch overwrites itself."""
    def _write(df: DataFrame, epoch_id: int) -> None:
        typed = df.select(_document_id(id_cols), *cols)      # typed columns: the format writes them whole
        typed.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}/epoch={epoch_id}")
    return _write


def topic_lines(df: DataFrame, cols: list[Column | str], as_json: bool = False, sep: str = ",") -> DataFrame:
    """The ``value`` column a topic or a text file receives."""
    v = encode_json(*cols) if as_json else encode_line(*cols, sep=sep)
    return df.select(v.alias("value"))


def write_topic(lines: DataFrame, path: str | None = None, bootstrap: str | None = None,
                topic: str | None = None) -> None:
    """S7 batch write: text files, or a Kafka topic when the connector is on the classpath."""
    if bootstrap and topic:
        (lines.write.format("kafka").option("kafka.bootstrap.servers", bootstrap)
         .option("topic", topic).save())
    elif path:
        lines.write.mode("overwrite").text(path)
    else:
        raise ValueError("give a path or a Kafka bootstrap + topic")
