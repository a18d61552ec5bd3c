import hashlib
import random
import re
from collections import defaultdict

import pytest

from tidemark.llm import mixing


def brute_targets(size, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by repeated sharing: whoever is above the limit is held there, the rest share again."""
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, budget, free = {}, share * sum(size.values()), set(names)
    while free:
        level = (budget - sum(most * size[s] for s in names if s not in free)) / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > most * size[s]}
        if not over:
            break
        free -= over
    for s in names:
        target[s] = w[s] * level if s in free else most * size[s]
    return target


def rows_of(seed, n=400):
    rnd = random.Random(seed)
    out = [(i, "w " * rnd.choice([0, 1, 5, 40, 300]), rnd.choice(["a", "a", "a", "B", "é", "c1", None, "zz"])) for i in range(n)]
    return out + [(None, None, "a"), (7, "x\ty\nz\x0b q", "zz"), (7, "x\ty\nz\x0b q", "zz"), (8, "", "empty")]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_plan_against_brute_force(spark, seed):
    rows = rows_of(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size, per = [], defaultdict(int)
    for _, t, s in rows:
        size.append(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")))
        per[s] += size[-1]
    target = brute_targets(per)
    want = []
    for (i, t, s), n in zip(rows, size):
        rate = target[s] / per[s] if per[s] else 0.0
        own = hashlib.md5((t or "").encode()).hexdigest()
        u = int(hashlib.md5(f"mix-1:{'' if i is None else i}:{own}".encode()).hexdigest()[:13], 16) / 2**52
        want.append((i, n, per[s], target[s], n * (int(rate) + (u < rate - int(rate)))))
    got = [tuple(r) for r in mixing.plan_mix(df).select("doc_id", "size", "source_size", "target", "taken").collect()]
    key = lambda r: (str(r[0]), r[1], r[2], r[4])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    assert sum(target.values()) == pytest.approx(1.5 * sum(per.values()))
    assert all(r[4] <= 2 * r[1] for r in got)


def test_mix_emits_each_document_as_often_as_planned(spark):
    rows = rows_of(4)
    df = spark.createDataFrame([(*r, 5, "k") for r in rows], "doc_id long, text string, source string, copies int, lang string")
    plan = defaultdict(list)
    for r in mixing.plan_mix(df).collect():
        plan[r["doc_id"], r["source"]].append(r["copies"])
    out = defaultdict(int)
    for r in mixing.mix(df).collect():
        out[r["doc_id"], r["source"]] += 1
        assert 1 <= r["copy"] <= r["copies"] and r["lang"] == "k"
    assert dict(out) == {k: sum(v) for k, v in plan.items() if sum(v)}
    again = sorted(map(str, mixing.mix(df.repartition(7)).collect()))
    assert again == sorted(map(str, mixing.mix(df).collect()))
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.plan_mix(df.limit(0)).count() == 0


def test_taken_words_come_near_the_targets(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(9)
    df = spark.createDataFrame([(i, "w " * rnd.randint(50, 150), f"s{i % 4}") for i in range(8000)], "doc_id long, text string, source string")
    for r in mixing.plan_mix(df).groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect():
        assert r["n"] == pytest.approx(r["t"], rel=0.05)


def test_lookup_beyond_broadcast_is_salted_and_equal(spark):
    rows = rows_of(6)
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = sorted(map(str, mixing.plan_mix(df).collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, mixing.plan_mix(df).collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
