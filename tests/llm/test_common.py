"""Shared helpers: samples of tables full of copies, column lookup, joins beside clashing names."""

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, mixing, quality, secretscan, simhash
from tidemark.llm.common import bounded_sample, lookup, resolve, scratch


def test_sample_of_copies_is_never_empty(spark):
    copies = spark.range(5000).select(F.lit("one text").alias("t"))
    assert [r["t"] for r in bounded_sample(copies, ["t"], 50).collect()] == ["one text"]
    mixed = copies.unionByName(spark.range(40).select(F.concat(F.lit("text "), F.col("id").cast("string")).alias("t")))
    got = {r["t"] for r in bounded_sample(mixed, ["t"], 30).collect()}
    assert len(got) == 30
    assert len(bounded_sample(mixed, ["t"], 500).collect()) == 41


def test_sample_is_the_rows_of_smallest_hash_at_any_size(spark):
    df = spark.range(20_000).select("id", F.xxhash64("id").alias("h"))
    want = [r["id"] for r in df.orderBy("h").limit(100).collect()]
    assert [r["id"] for r in bounded_sample(df.select("id"), ["id"], 100).collect()] == want


def test_language_of_many_copies_is_learned(spark):
    one = spark.range(3000).select(F.lit("immer wieder derselbe deutsche Satz steht hier").alias("text"), F.lit("de").alias("lang"))
    many = spark.range(900).select(F.concat(F.lit("some english words stand here number "), F.col("id").cast("string")).alias("text"), F.lit("en").alias("lang"))
    model = langid.fit(one.unionByName(many), sample_rows=50)
    assert list(model.langs) == ["de", "en"]
    out = langid.predict(spark.createDataFrame([("derselbe deutsche Satz",), ("english words stand",)], "text string"), model)
    assert [r["lang_pred"] for r in out.collect()] == ["de", "en"]


def test_columns_are_found_as_spark_finds_them_or_refused(spark):
    df = spark.createDataFrame([(1, "words of a text stand here", "x")], "doc_id long, Text string, other string")
    assert resolve(df, "text") == "Text"
    for name in ("absent", "texts"):
        with pytest.raises(ValueError):
            resolve(df, name)
    bench = spark.createDataFrame([("i", "of a text")], "item_id string, text string")
    assert simhash.with_fingerprints(df).first()["fp"] == simhash.with_fingerprints(df.withColumnRenamed("Text", "text")).first()["fp"]
    assert decontaminate.scan(df, bench).first()["n_hit"] == 3
    for run in (lambda d: simhash.with_fingerprints(d), lambda d: decontaminate.scan(d, bench), lambda d: langid.predict(d, None),
                lambda d: quality.score(d, None), lambda d: secretscan.find(d, None)):
        with pytest.raises(ValueError):
            run(df.drop("Text"))


def test_joins_and_mixes_keep_columns_with_odd_names(spark):
    rows = [(i, "a b c d", f"s{i % 2}", "mine", 7, 8, 9) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, _salt string, _r_source int, _draw int, _key_0 int")
    out = mixing.mix(df)
    assert {"_salt", "_r_source", "_draw", "_key_0"} <= set(out.columns)
    assert {(r["_salt"], r["_r_source"], r["_draw"], r["_key_0"]) for r in out.collect()} == {("mine", 7, 8, 9)}
    small = spark.createDataFrame([("s0", 1), (None, 2)], "source string, v int")
    got = lookup(df, small, ["source"], F.col("doc_id"))
    assert got.columns == [*df.columns, "v"] and {(r["source"], r["v"]) for r in got.collect()} == {("s0", 1), ("s1", None)}


def test_rows_that_share_an_id_draw_apart(spark):
    rows = [(None, f"w{i} " * 10, "a") for i in range(600)] + [(1, f"v{i} " * 10, "b") for i in range(300)]
    out = mixing.plan_mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    for r in out.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect():
        assert abs(r["taken"] - r["target"]) < 0.1 * r["target"]


def test_lookup_beyond_the_broadcast_size_is_dealt_out_and_never_broadcast(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id") % 50).alias("k"), "id")
    small = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(None, -1)], "k long, v long"))
    small = scratch(small, "test-small")                     # a written table has a size
    want = sorted((r["id"], -1 if r["k"] is None else r["k"] * 2) for r in df.collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit, name in (("10m", "Broadcast"), ("100", "SortMergeJoin")):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            out = lookup(df, small, ["k"], F.col("id"))
            assert sorted((r["id"], r["v"]) for r in out.collect()) == want
            assert name in out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
