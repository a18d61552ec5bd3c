"""Every pipeline stage on its own input against brute force, and the queries on small tables."""

import hashlib

import corpus_pipeline
import pytest
from test_decontaminate import brute as contaminated
from test_mixing import brute_targets
from test_simhash import slow_fingerprint, slow_groups

from tidemark.llm import queries, quality, secretscan
from tidemark.llm.common import fold, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def run(spark):
    """(rows in, rows out) of each stage, each reading what the one before kept."""
    docs, out = table(spark, SF, "documents").cache(), []
    first = docs
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, docs, SF).cache()
        out.append((name, docs, kept))
        docs = kept
    yield first, out
    spark.catalog.clearCache()


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_stages_and_columns(run):
    docs, out = run
    assert [n for n, _, _ in out] == ["quality classifier", "simhash near-dedup", "benchmark decontamination", "secret scans", "mix sources"]
    assert all(k.columns == docs.columns for _, _, k in out[:-1])


def test_quality_stage(spark, run):
    _, before, after = run[1][0]
    model = quality.fit(before, table(spark, SF, "labels"), fold("doc_id", 3) != 1)
    every = before.collect()
    want = [tuple(r) for r, s in zip(every, model.scores([r["text"] for r in every])) if s >= 0.5]
    assert rows(after) == sorted(want, key=str) and 0 < len(want) < len(every)


def test_simhash_stage(run):
    _, before, after = run[1][1]
    every = before.collect()
    fps = [slow_fingerprint(r["text"]) for r in every]
    group = slow_groups(fps, 3)
    least = {}
    for r, f in zip(every, fps):
        least[group[f]] = min(least.get(group[f], r["doc_id"]), r["doc_id"])
    assert rows(after) == sorted((tuple(r) for r in every if r["doc_id"] in least.values()), key=str)


def test_decontamination_stage(spark, run):
    _, before, after = run[1][2]
    items = [(str(r["item_id"]), r["text"]) for r in table(spark, SF, "benchmark").collect()]
    hit = {r[0] for r in contaminated([(r["doc_id"], r["text"]) for r in before.collect()], items) if r[2]}
    assert rows(after) == sorted((tuple(r) for r in before.collect() if r["doc_id"] not in hit), key=str)


def test_secrets_stage(run):
    _, before, after = run[1][3]
    field, want = secretscan.fit(before), []
    for r in before.collect():
        t, end, out = r["text"] or "", 0, ""
        spans = secretscan.scan_texts(field, [t.encode()])[0]
        for s in spans:
            if s["start"] >= end:
                out += t[end:s["start"]] + "[SECRET]"
            end = max(end, s["end"])
        d = r.asDict() | ({"text": out + t[end:], "n_chars": len(out + t[end:])} if spans else {})
        want.append(tuple(d[c] for c in before.columns))
    assert rows(after) == sorted(want, key=str)


def test_mix_stage(run):
    _, before, after = run[1][4]
    per, every = {}, before.collect()
    for r in every:
        per[r["source"]] = per.get(r["source"], 0) + len((r["text"] or "").split())
    target, want = brute_targets(per), {}
    for r in every:
        rate = target[r["source"]] / per[r["source"]] if per[r["source"]] else 0
        own = hashlib.md5((r["text"] or "").encode()).hexdigest()
        u = int(hashlib.md5(f"mix-1:{r['doc_id']}:{own}".encode()).hexdigest()[:13], 16) / 2**52
        want[r["doc_id"]] = int(rate) + (u < rate - int(rate))
    got = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {k: v for k, v in want.items() if v}


def test_all_queries_are_registered(spark):
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 14):
        assert len([q for q in names if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and set(queries.ORACLE_SQL) <= set(names)
