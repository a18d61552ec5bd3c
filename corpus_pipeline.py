"""The corpus pipeline: documents through five of the operators in ``tidemark.llm``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, mixing, quality, secretscan, simhash
from tidemark.llm.common import fold, scratch, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored under 0.5 go."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels"), fold("doc_id", 3) != 1))


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-duplicates (3-word shingles, at most 3 bits): one document of each group stays."""
    return simhash.keep_one(docs, k=3, max_bits=3)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with any benchmark window go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), width=10)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: every span is replaced by a mark, all documents stay."""
    return secretscan.redact(docs, secretscan.fit(docs))


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: documents are emitted as often as the mix takes them."""
    return mixing.mix(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", decontamination_stage),
    ("secret scans", secrets_stage),
    ("mix sources", mix_stage),
]

# The quality classifier has no SQL form; tests/llm/test_pipeline.py holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = scratch(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
