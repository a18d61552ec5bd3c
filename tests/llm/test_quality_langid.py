import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import langid, ngrams, quality
from tidemark.llm.common import fold

SF = "/root/testdata/sf0.01"


def test_document_counts_cover_all_rows(spark):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df, n = ngrams.document_counts(spark.read.parquet(f"{SF}/documents.parquet").repartition(5), langid.WIDTH, langid.vector)
    assert n == len(texts)
    assert (df == sum((langid.vector(t) > 0).astype(int) for t in texts)).all()


def test_neighbour_vote_is_the_definition():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdef \n")) for _ in range(60)) for _ in range(40)]
    y = [int(i % 3 > 0) for i in range(40)]
    df = sum((quality.vector(t) > 0).astype(int) for t in texts)
    m = quality.fit_model(texts, y, df, len(texts), dims=10, neighbours=5)
    asked = [*texts[:7], None, "", "abc", "漢字"]
    got = m.scores(asked)
    p = m.project(asked)
    for v, g in zip(p, got):
        near = m.points @ v
        best = np.argsort(-near, kind="stable")[:5]
        w = np.maximum(near[best], 0).astype(float)
        want = (w * m.labels[best]).sum() / w.sum() if w.sum() > 0 else m.labels.mean()
        assert abs(g - want) < 1e-5
    assert ((0 <= got) & (got <= 1)).all()


def test_quality_on_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    m = quality.fit(docs, labels, fold("doc_id", 3) != 1)
    rows = (quality.score(docs.select("doc_id", "text"), m).join(labels.where("quality is not null"), "doc_id").where(fold("doc_id", 3) == 1).collect())
    right = np.mean([(r["score"] >= 0.5) == (r["quality"] == 1) for r in rows])
    junk = [r["score"] < 0.5 for r in rows if r["quality"] == 0]
    good = [r["score"] >= 0.5 for r in rows if r["quality"] == 1]
    assert right >= 0.95 and np.mean(junk) >= 0.7 and np.mean(good) >= 0.97


def test_quality_edges(spark):
    rows = [(1, "plain words here", "a"), (2, None, "b"), (2, None, "b"), (None, "", "c"), (4, "w " * 60_000, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, Text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    m = quality.fit(docs, none, F.lit(True))
    kept = quality.keep_good(docs, m)
    assert kept.columns == docs.columns and sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    lab = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (9, 1, 1), (4, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    m = quality.fit(docs, lab, F.lit(True))
    assert sorted(m.labels) == [0, 1]                       # a repeated document is learned from once
    assert quality.keep_good(docs.limit(0), m).count() == 0
    assert quality.fit(docs.limit(0), lab, F.lit(True)).scores(["x"])[0] == 1.0


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    m = langid.fit(docs.where(fold("doc_id", 4) != 2))
    rows = langid.predict(docs.where(fold("doc_id", 4) == 2), m).where("lang is not null").collect()
    good = [r for r in rows if langid.has_letter(r["text"])]
    assert np.mean([r["lang"] == r["lang_pred"] for r in good]) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert zlib.crc32(b"5") % 4 == docs.select(fold(F.lit(5), 4)).first()[0]


def test_language_edges(spark):
    m = langid.fit_model({"aa": ["one two three", "two three four"], "bb": ["żółw ćma źdźbło"]}, np.zeros(langid.WIDTH, int), 3)
    pred, score, rejected = m.predict([None, "", "123 !?", "ćma", "TWO three", "漢字 漢字"])
    assert pred[:5] == ["und", "und", "und", "bb", "aa"] and pred[5] in ("aa", "bb") and rejected[5]
    assert score[0] == 0 and score[4] > 0.5
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    out = langid.predict(df, m).collect()
    assert sorted(r["lang_pred"] for r in out) == ["aa", "aa", "und"]
    assert langid.predict(df.limit(0), m).count() == 0
    empty = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert empty.predict(["one two"])[0] == ["und"]


def test_language_is_the_definition():
    """Centroids are means of their clusters, the prediction the centroid of largest cosine (the first of equal
    ones), rejected below its language's radius."""
    rng = np.random.default_rng(4)
    samples = {lang: ["".join(rng.choice(list(letters)) for _ in range(80)) for _ in range(30)]
               for lang, letters in (("aa", "abcdef "), ("bb", "cdefgh "), ("cc", "xyzuvw "))}
    texts = [t for ts in samples.values() for t in ts]
    df = sum((langid.vector(t) > 0).astype(int) for t in texts)
    m = langid.fit_model(samples, df, len(texts), centroids=3)
    idf = ngrams.inverse(df, len(texts))
    rows = {k: ngrams.tf_idf(ts, langid.vector, idf) for k, ts in samples.items()}
    for k, lang in enumerate(m.langs):
        mine = m.centroids[m.owner == k]
        near = (rows[lang] @ mine.T).argmax(axis=1)
        for c in range(len(mine)):
            mean = rows[lang][near == c].sum(axis=0)
            assert np.abs(mine[c] - mean / np.linalg.norm(mean)).max() < 1e-3
    asked = [*texts[::7], "漢字 漢字", "abc xyz", "z" * 100_000]
    pred, score, rejected = m.predict(asked)
    for t, p, s, r in zip(asked, pred, score, rejected):
        v = ngrams.tf_idf([t], langid.vector, idf)[0]
        cos = m.centroids @ v
        best = int(np.flatnonzero(cos == cos.max())[0])
        assert p == m.langs[m.owner[best]] and abs(s - max(0.0, min(1.0, float(cos[best])))) < 1e-5
        edge = m.radius[m.owner[best]]
        assert r == (cos[best] < edge) or abs(cos[best] - edge) < 1e-6


def test_equal_cosines_go_to_the_first_language():
    m = langid.fit_model({"bb": ["same words here"], "aa": ["same words here"]}, np.ones(langid.WIDTH, int), 2)
    assert m.predict(["same words here"])[0] == ["aa"]
