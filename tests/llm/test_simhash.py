import random
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash
from tidemark.llm.graph import components

SF = "/root/testdata/sf0.01"


def slow_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def slow_groups(fps, bits):
    """{fp: smallest member} by comparing all pairs."""
    fps = sorted(set(fps))
    up = {f: f for f in fps}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(fps):
        for y in fps[:i]:
            if (x ^ y).bit_count() <= bits:
                a, b = find(x), find(y)
                up[max(a, b)] = min(a, b)
    return {f: find(f) for f in fps}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def expected(rows, bits=3):
    fp = [(i, slow_fingerprint(t)) for i, t in rows]
    group = slow_groups([f for _, f in fp], bits)
    least = {}
    for i, f in fp:
        if i is not None:
            least[group[f]] = min(least.get(group[f], i), i)
    return sorted(((i, signed(f), least.get(group[f])) for i, f in fp), key=str)


def got(spark, rows, bits=3):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = simhash.near_duplicates(df, max_bits=bits).select("doc_id", "fp", "component_id").collect()
    return sorted(map(tuple, out), key=str)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab AZÉß\t\n\x0b\x1c  x", max_size=40))
def test_fingerprint_is_the_definition(text):
    assert simhash.fingerprint(text) == slow_fingerprint(text)


def test_whole_small_table_against_all_pairs(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(spark, rows) == expected(rows)


def test_nulls_empty_long_repeated_and_null_ids(spark):
    rnd = random.Random(5)
    words = [rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(60_000)]
    rows = [(3, None), (2, ""), (9, " \t\n"), (5, "One two"), (5, "one TWO"), (5, "one TWO"), (None, "one two"),
            (None, "alone it is"), (7, " ".join(words)), (8, " ".join(words[:-3] + ["zz"]))]
    assert got(spark, rows) == expected(rows)
    assert got(spark, []) == []


def test_planted_distances_are_all_linked(spark, monkeypatch):
    rnd = random.Random(1)
    fps = set()
    for _ in range(150):                                  # groups around random centres, 0 to 5 bits off
        c = rnd.getrandbits(64)
        fps |= {c} | {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 5))) for _ in range(6)}
    dense = rnd.getrandbits(64)                           # one anchor with far more homes than the bound
    fps |= {dense ^ rnd.getrandbits(7) for _ in range(100)} | {dense ^ 1 << b for b in range(64)}
    want = slow_groups(fps, 3)
    for hot in (2048, 8):
        monkeypatch.setattr(simhash, "HOT_HOMES", hot)
        monkeypatch.setattr(simhash, "PAIRS_AT_ONCE", 50)
        df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
        roots = {r["fp"] & (1 << 64) - 1: r["root"] for r in simhash.label(df).collect()}
        assert set(roots) == fps
        pairs = {(roots[f], want[f]) for f in fps}
        assert len(pairs) == len({a for a, _ in pairs}) == len({b for _, b in pairs})


def test_groups_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rnd = random.Random(2)
        c = rnd.getrandbits(64)
        fps = {c ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 2))) for _ in range(120)}
        df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
        roots = [r["root"] for r in simhash.label(df).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(set(roots)) == len(set(slow_groups(fps, 3).values()))


def test_keep_one_row_of_each_group_and_clashing_columns(spark):
    rows = [(4, "a b c d", "x"), (2, "A b c d", "y"), (2, "A b c d", "y"), (6, None, "z"), (None, "", "z"),
            (None, "quite another text here", "z"), (None, "and a third one of them", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _fp string")
    out = sorted(map(tuple, simhash.keep_one(df).collect()), key=str)
    assert out == sorted([rows[1], rows[3], rows[5], rows[6]], key=str)


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1400)] + [(5000, 5000), (7, 3)]
    df = spark.createDataFrame(links, "a long, b long")
    roots = {r["id"]: r["root"] for r in components(df).collect()}
    assert len({roots[i] for i in range(301)}) == 1 and len({roots[i] for i in range(1000, 1400)}) == 1
    assert roots[0] != roots[1000]
    assert components(df.limit(0)).count() == 0
