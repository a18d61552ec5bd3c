"""Sinks (S3-S5, S7) and the report text formatter (K4)."""

from tidemark.sinks.sinks import (  # noqa: F401
    console, report_text, upsert_rows, merge_statement, jdbc_upsert_writer, documents, document_writer, topic_lines,
    write_topic,
)
from tidemark.sinks.tagged import tagged_writer  # noqa: F401
