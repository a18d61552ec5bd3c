"""Line dedup against a brute-force version."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm import linededup

SCHEMA = "doc_id long, text string"
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, min_chars, min_docs):
    def key(line):
        return line.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(UP)

    docs, last = defaultdict(set), {}
    for d, text in rows:
        for line in (text or "").split("\n"):
            docs[key(line)].add(d)
    gone = {k for k, ids in docs.items() if len(k) >= min_chars and len(ids) >= min_docs}
    last = {k: max(docs[k], key=lambda d: (d is not None, d or 0)) for k in gone}
    out = []
    for d, text in rows:
        lines = (text or "").split("\n")
        left = [x for x in lines if key(x) not in gone or last[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return sorted(out, key=str)


def run(spark, rows, min_chars=40, min_docs=5, df=None):
    df = spark.createDataFrame(rows, SCHEMA) if df is None else df
    got = linededup.drop_repeated_lines(df, min_chars=min_chars, min_docs=min_docs).select("doc_id", "n_lines", "n_dropped", "text")
    return sorted([tuple(r) for r in got.collect()], key=str)


def test_random_texts(spark):
    rng = random.Random(5)
    pool = ["aaaa bbbb", " AAAA bbbb\t", "ccc", "Éééé dddd", "éééé dddd", "x" * 9, "", " ", "y\r", " aaaa bbbb"]
    rows = [(i % 37, "\n".join(rng.choice(pool) for _ in range(rng.randint(0, 9)))) for i in range(60)]
    for min_docs in (2, 9):
        assert run(spark, rows, 4, min_docs) == brute(rows, 4, min_docs)


def test_threshold_counts_documents_and_code_points(spark):
    line = "é" * 40
    four = [(i, f"{line}\n{line}\nrest") for i in range(4)]
    assert run(spark, four) == brute(four, 40, 5) and all(r[2] == 0 for r in run(spark, four))
    five = four + [(9, "  " + "é" * 40 + "\r\nend")]
    got = run(spark, five)
    assert got == brute(five, 40, 5)
    assert [r[2] for r in got] == [2, 2, 2, 2, 0]
    short = [(i, "é" * 39) for i in range(9)]
    assert all(r[2] == 0 for r in run(spark, short))


def test_nulls_empty_repeats_and_long(spark):
    line = "the same long line that many documents share with each other"
    long = "\n".join([line] * 3 + [f"own line number {i} of a very long document that goes on" for i in range(20_000)] + [line])
    rows = [(None, line), (None, f"a\n{line}"), (1, line), (1, line), (2, None), (2, ""), (3, long), (4, f"{line}\n"), (5, line.upper()), (5, f"x\n{line}\ny")]
    assert run(spark, rows) == brute(rows, 40, 5)
    assert run(spark, rows, min_docs=6) == brute(rows, 40, 6)


def test_null_id_is_the_lowest(spark):
    line = "z" * 50
    rows = [(None, line)] + [(i, line) for i in range(4)]
    got = dict((r[0], r[2]) for r in run(spark, rows))
    assert got == {None: 1, 0: 1, 1: 1, 2: 1, 3: 0}


def test_empty_table_extra_and_clashing_columns(spark):
    assert run(spark, []) == []
    rows = [(i, "q" * 45 + "\nkeep") for i in range(6)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"N_Lines": F.lit("mine"), "_lines": F.lit(1), "d": F.lit(2), "gone": F.lit(3), "_d": F.lit(4)})
    out = linededup.drop_repeated_lines(df)
    assert {"_lines", "d", "gone", "_d", "n_lines", "n_dropped"} <= set(out.columns) and "N_Lines" not in out.columns
    assert run(spark, rows, df=df) == brute(rows, 40, 5)
    assert [r["_d"] for r in out.collect()] == [4] * 6


def test_a_line_of_all_documents_is_split(spark):
    rows = [(i, "common line of every document of the whole table\n" + f"own {i}") for i in range(3000)]
    assert run(spark, rows) == brute(rows, 40, 5)
