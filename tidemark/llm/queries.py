"""The registered queries ``opN_<name>`` over the whole given tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import conversations, decontaminate, embeddings, htmltext, langid, lattice, linededup, merkle, mixing, quality, repeats, secretscan, simhash
from tidemark.llm.common import fold, table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words every document gives to the mix of all documents."""
    return (mixing.plan_mix(table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and tagged secret spans of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secretscan.find(docs, secretscan.fit(docs), drop_text=True)

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *[count(k) for k in secretscan.KINDS],
                        F.sha2(secretscan.joined("spans", secretscan.KINDS[:3]), 256).alias("base_sha256"),
                        secretscan.joined("spans").alias("spans"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words found in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.scan(docs, table(spark, sf_dir, "benchmark"), width=10, drop_text=True)
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        decontaminate.items_digest("items").alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op4_embedding_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine >= 0.9 and component of every vector."""
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.9)


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document (3-word shingles, at most 3 bits apart)."""
    return (simhash.near_duplicates(table(spark, sf_dir, "documents"), k=3, max_bits=3)
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    held_out = fold("doc_id", 4) == 2
    model = langid.fit(docs.where(~held_out))
    return (langid.predict(docs.select("doc_id", "text"), model, drop_text=True)
            .select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected"))


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document covered by 400-byte strings that come more than once."""
    return (repeats.remove_repeats(table(spark, sf_dir, "documents"), length=400)
            .select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 3) == 1
    model = quality.fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return (quality.score(docs, model, drop_text=True)
            .select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subword lattice and word unigram log-probability of every document."""
    docs = table(spark, sf_dir, "documents")
    return lattice.score(docs.select("doc_id", "text", (fold("doc_id", 10) == 0).alias("held_out")))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and recomputed root of every document; every seventh leaf (by crc32 of the id) is tampered with."""
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in merkle.FIELDS]
    changed = [F.col(c) + F.lit(1) if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % F.lit(7) == 0, F.lit(False))
    start = F.when(tampered, merkle.leaf_of(changed)).otherwise(merkle.leaf_of(fields))
    made = merkle.manifest(docs, also={"start": start})
    return (made.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"),
                        merkle.folded(F.col("start"), F.col("path")).alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 code points or more that stand in 5 or more documents, kept in the last of them."""
    return (linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=40, min_docs=5)
            .select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and cheapest repair of every conversation, after planted damage."""
    rows = table(spark, sf_dir, "conversations")
    return (conversations.repair(conversations.damage(rows), every=rows.select("conv_id"))
            .select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_secret_scan": op2_secret_scan,
    "op3_decontaminate": op3_decontaminate,
    "op4_embedding_groups": op4_embedding_groups,
    "op5_simhash_groups": op5_simhash_groups,
    "op6_language": op6_language,
    "op7_repeats": op7_repeats,
    "op8_quality": op8_quality,
    "op9_html_text": op9_html_text,
    "op10_lm_score": op10_lm_score,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_line_dedup": op12_line_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op1_mix_sources": mixing.ORACLE,
    "op3_decontaminate": decontaminate.ORACLE,
    "op4_embedding_groups": embeddings.ORACLE,
    "op7_repeats": repeats.ORACLE,
    "op9_html_text": htmltext.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_line_dedup": linededup.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}
