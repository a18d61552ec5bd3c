"""Merkle manifest against a brute-force tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle
from tidemark.llm.queries import op11_merkle_manifest

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes, arity):
    """(last node, per node its (left, right) siblings by level)."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        runs = [level[i:i + arity] for i in range(0, len(level), arity)]
        for k, a in enumerate(at):
            run, slot = runs[a // arity], a % arity
            paths[k].append(("".join(run[:slot]), "".join(run[slot + 1:])))
            at[k] = a // arity
        level = [h(*r) for r in runs]
    return level[0], paths


def brute(rows, arity=2):
    by = defaultdict(list)
    for r in rows:
        by[r[2]].append(r)
    langs = sorted(by, key=lambda g: (g is not None, (g or "").encode()))
    trees, out = {}, []
    for g in langs:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g] = tree([leaf(r) for r in by[g]], arity)
    root, tops = tree([trees[g][0] for g in langs], arity)
    for g, top in zip(langs, tops):
        for r, path in zip(by[g], trees[g][1]):
            out.append((r[0], leaf(r), trees[g][0], root, h(*[a + b for a, b in path + top])))
    return sorted(out, key=str)


def made(spark, rows, **kw):
    m = merkle.manifest(spark.createDataFrame(rows, SCHEMA), **kw)
    m = m.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("p"),
                 merkle.folded(F.col("leaf"), F.col("path")).alias("folded"))
    got = [tuple(r) for r in m.collect()]
    assert all(r[5] == r[3] for r in got)
    return sorted([r[:5] for r in got], key=str)


def rows_of(n, langs=("en", "en", "en", "de", None)):
    return [(i * 3 % 101, f"s{i % 3}", langs[i % len(langs)], i, "é" * (i % 5)) for i in range(n)]


@pytest.mark.parametrize("n,arity,levels", [(1, 2, 2), (61, 2, 2), (60, 3, 1), (33, 2, 10)])
def test_equals_brute_force(spark, n, arity, levels):
    rows = rows_of(n)
    assert made(spark, rows, arity=arity, levels=levels) == brute(rows, arity)


def test_many_groups_and_one_hot_group(spark):
    rows = [(i, None, f"g{i:02d}", i, None) for i in range(40)] + [(i, "x", "hot", 0, "") for i in range(90)]
    assert made(spark, rows, levels=3) == brute(rows)


def test_nulls_repeats_ties_and_long_texts(spark):
    rows = [(None, None, None, None, None)] * 3 + [(7, "a", "en", 1, "x" * 300_000), (7, "a", "en", 1, ""), (7, "b", "en", None, None)] * 2
    rows += [(2, "é", "", 5, "t"), (2, "é", "日本", 5, "t")]
    assert made(spark, rows, levels=2) == brute(rows)


def test_rows_spread_over_many_partitions(spark):
    rows = rows_of(300)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert made(spark, rows, levels=4) == brute(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_table_extra_and_clashing_columns(spark):
    assert made(spark, []) == []
    rows = rows_of(9)
    extra = spark.createDataFrame(rows, SCHEMA).withColumns({"leaf": F.lit("mine"), "_part": F.lit(1), "g": F.lit("g"), "pos": F.lit(0)})
    got = sorted([tuple(r) for r in merkle.manifest(extra).select("doc_id", "leaf", "subroot").collect()], key=str)
    assert got == sorted([r[:3] for r in brute(rows)], key=str)
    with pytest.raises(ValueError):
        merkle.manifest(extra, order="leaf")


def test_tampered_rows_are_told(spark):
    got = op11_merkle_manifest(spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(got) == len(docs)
    for r in got:
        changed = zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and docs[r["doc_id"]]["n_chars"] is not None
        assert r["verified"] == (not changed) == (r["folded_root"] == r["root"])
