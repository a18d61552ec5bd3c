import re

from tidemark.llm import decontaminate as dc

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def brute(docs, items, width=10):
    wins = {}
    for i, t in items:
        w = WORD.findall(low(t))
        for k in range(max(1, len(w) - width + 1) if w else 0):
            wins.setdefault(tuple(w[k:k + width]), set()).add(i)
    sizes = {len(x) for x in wins}
    out = []
    for d, t in docs:
        at = [m for m in WORD.finditer(low(t))]
        w = [m[0] for m in at]
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                ids = wins.get(tuple(w[k:k + n]))
                if ids:
                    found |= ids
                    hit |= set(range(k, k + n))
        spans = []
        for k in sorted(hit):
            if k - 1 in hit:
                spans[-1][1] = at[k].end()
            else:
                spans.append([at[k].start(), at[k].end()])
        out.append((d, len(w), len(hit), sorted(found), [tuple(s) for s in spans]))
    return sorted(out, key=str)


def got(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string, items int")
    b = spark.createDataFrame(items, "item_id string, text string")
    rows = dc.scan(d, b, **kw).select("doc_id", "n_words", "n_hit", "items", "spans").collect()
    return sorted(((r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]]) for r in rows), key=str)


ITEMS = [("a", "One two THREE four five six seven eight nine ten eleven"), ("b", "short item"), ("c", None), ("d", "  ,.; "),
         ("e", "ñu Ça ñu ça ñu Ça ñu Ça ñu ça ñu ça"), ("b", "another one-two"), ("f", "two three four five six seven eight nine ten eleven twelve")]
DOCS = [(1, None), (2, ""), (3, "x one, two; three FOUR five six seven eight nine ten eleven twelve y short  item."), (3, "short\nITEM short item"),
        (4, "ñu Ça ñu ça ñu Ça ñu Ça ñu ça ñu ça ñu"), (None, "an other one.two shortitem"), (5, "another-ONE--two " * 3),
        (6, "w " * 50_000 + "short item" + " z" * 50_000), (7, "one two three four five six seven eight nine")]


def test_edges_against_brute_force(spark):
    want = brute(DOCS, ITEMS)
    docs = [(*d, 1) for d in DOCS]
    assert got(spark, docs, ITEMS) == want
    assert got(spark, [], ITEMS) == [] and got(spark, docs, []) == brute(DOCS, [])


def test_many_parts_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(dc, "PART_BYTES", 400)
    assert got(spark, [(*d, 1) for d in DOCS], ITEMS) == brute(DOCS, ITEMS)


def test_whole_small_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").selectExpr("cast(item_id as string)", "text").collect()]
    assert got(spark, [(*d, 1) for d in docs], items) == brute(docs, items)


def test_clean_keeps_clean_rows_as_they_are(spark):
    d = spark.createDataFrame([(1, "short item", 2, "s"), (2, "fine text", None, None), (2, None, 5, "x")], "Doc_id int, Text string, n_hit int, c0 string")
    b = spark.createDataFrame([("b", "short item")], "item_id string, text string")
    out = dc.clean(d, b)
    assert out.columns == d.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(2, "fine text", None, None), (2, None, 5, "x")], key=str)
