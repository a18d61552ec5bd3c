import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lattice as lt

SF = "/root/testdata/sf0.01"


def spellings(word, pieces):
    """All segmentations of a byte string into pieces."""
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in pieces:
            for rest in spellings(word[n:], pieces):
                yield [word[:n], *rest]


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(1)
    start = list(lt.START.decode("latin-1").encode("latin-1"))
    texts = sorted({bytes([c]) for c in b"abcxyz"} | {bytes([c]) for c in start} | {lt.START, lt.START + b"a", b"ab", b"abc", b"bc", b"ca", b"xyz", lt.START + b"xy"})
    return lt.Pieces(texts, len(texts), np.log(rng.dirichlet(np.ones(len(texts) + 1))))


def test_marginal_and_expected_counts_are_sums_over_all_segmentations(small):
    rnd = random.Random(2)
    words = ["".join(rnd.choice("abcxyz") for _ in range(rnd.randint(1, 7))).encode() for _ in range(60)]
    number = {t: i for i, t in enumerate(small.texts)}
    a = small.automaton()
    got = lt.word_logp(a, small.logp, words)
    counts = np.array([rnd.randint(1, 5) for _ in words], float)
    want_counts = np.zeros(len(small.logp))
    for w, g, c in zip(words, got, counts):
        ways = list(spellings(lt.START + w, number))
        ps = [math.exp(sum(small.logp[number[p]] for p in way)) for way in ways]
        assert g == pytest.approx(math.log(sum(ps)))
        for way, p in zip(ways, ps):
            for x in way:
                want_counts[number[x]] += c * p / sum(ps)
    assert lt.expected_counts(a, small.logp, words, counts) == pytest.approx(want_counts)


def test_vocabulary_file_spells_every_text():
    pieces = lt.Pieces.load()
    a = pieces.automaton()
    assert np.exp(pieces.logp).sum() == pytest.approx(1)
    words = ["the", "ñandú", "漢字", "\x00\x01", "😀" * 50, "x" * 5000, "a\xa0b"]
    got = lt.word_logp(a, pieces.logp, [w.encode() for w in words])
    assert np.isfinite(got).all() and got[0] > got[2] > got[5]
    one = [lt.word_logp(a, pieces.logp, [w.encode()])[0] for w in words]
    assert got == pytest.approx(one)


def brute(rows, fold=10):
    toks = [[*(w.decode() for w in (t or "").encode().lower().split()), None] for _, t in rows]
    held = [zlib.crc32(str(i).encode() if i is not None else b"") % fold == 0 for i, _ in rows]
    c = Counter(w for t, h in zip(toks, held) if not h for w in t)
    n, v = sum(c.values()), len(c)
    return [(i, h, len(t), sum(c[w] > 0 for w in t), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t))
            for (i, _), t, h in zip(rows, toks, held)]


def run(spark, rows):
    from tidemark.llm.common import fold
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("held_out", fold("doc_id", 10) == 0)
    return [tuple(r) for r in lt.score(df).collect()]


def same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want])
    assert all(math.isfinite(r[6]) and r[6] < 0 for r in got)


ROWS = [(i, f"The word{i % 7} thé ÀB ab{i % 3} the\tthe\n") for i in range(40)] + [(50, None), (51, ""), (52, " \n"), (None, "the the"),
        (5, "the again"), (5, "the again"), (60, "long " * 30_000 + "x" * 3000), (61, "\x00 \x01 z 漢字 😀")]


def test_edges_against_brute_force(spark, monkeypatch):
    same(run(spark, ROWS), brute(ROWS))
    assert run(spark, []) == []
    held = [(i, "the") for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0]
    same(run(spark, held), brute(held))


def test_blocks_and_buckets_do_not_change_results(spark, monkeypatch):
    whole = run(spark, ROWS)
    monkeypatch.setattr(lt, "BLOCK_BYTES", 300)
    key = lambda r: (str(r[0]), r[5])
    small = run(spark, ROWS)
    for a, b in zip(sorted(whole, key=key), sorted(small, key=key)):
        assert a == pytest.approx(b)


def test_whole_small_table_and_held_out_gain(spark, monkeypatch):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = run(spark, rows)
    same(got, brute(rows))
    # learning from the corpus beats the vocabulary's own scores on held-out text
    monkeypatch.setattr(lt, "train_pieces", lambda vocabulary, n_docs, start, rounds: start)
    own = {(r[0], r[5]): r[6] for r in run(spark, rows)}
    held = [r for r in got if r[1]]
    assert sum(r[6] for r in held) > 0.8 * sum(own[r[0], r[5]] for r in held)


def test_ids_of_any_type(spark):
    rows = [(f"id-{i}" if i else None, f"some words number {i}", i % 10 == 0) for i in range(20)]
    got = lt.score(spark.createDataFrame(rows, "doc_id string, text string, held_out boolean")).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows)
