"""Language ID by nearest centroid (operator 6).

Hashed byte bigrams and trigrams of the lower-cased letters, TF-IDF with document counts over all
training documents, several centroids per language from spherical k-means on a bounded sample
(``sample_rows`` per language), cosine with every centroid.  A document further from its nearest
centroid than the language's radius (a low quantile of the sample's cosines) is marked
``rejected``; its nearest language is still given.

Only text and non-null lang of the training fold are learned from; lang, source and doc_id are no
inputs of a prediction.  Defined cases: a null text or one without a letter is ``und`` with score
0; so is every text if nothing could be learned; equal cosines go to the language first in
code-point order; repeated rows are predicted alike; an empty table gives no rows; input columns
``lang_pred``, ``score`` and ``rejected`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.common import lookup, resolve, scratch, share_below

BITS = 12
WIDTH = 2 << BITS
SAMPLE_ROWS = 300          # per language
CENTROIDS = 4              # per language
RADIUS_QUANTILE = 0.005
BLOCK = 256
_ASCII_LETTER = re.compile("[A-Za-z]")
_LETTERS = bytes(c if 97 <= c <= 122 or c >= 0x80 else 0x20 for c in range(256))
RESULT = ["lang_pred", "score", "rejected"]


def has_letter(text: str | None) -> bool:
    return bool(text) and (_ASCII_LETTER.search(text) is not None or any(map(str.isalpha, text)))


def vector(text: str | None) -> np.ndarray:
    """Bigram and trigram counts of the letters of a whole text."""
    data = (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS)
    a = np.frombuffer(b" " + b" ".join(data.split()) + b" ", np.uint8)
    return np.concatenate([np.bincount(ngrams.hashed(a, n, BITS), minlength=1 << BITS) for n in (2, 3)])


@dataclass
class Model:
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray  # one row per centroid
    owner: np.ndarray      # number of the language of each centroid
    radius: np.ndarray     # least cosine accepted, per language

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        pred, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        mine = [i for i, t in enumerate(texts) if len(self.langs) and has_letter(t)]
        for k in range(0, len(mine), BLOCK):
            part = mine[k:k + BLOCK]
            cos = ngrams.tf_idf([texts[i] for i in part], vector, self.idf) @ self.centroids.T
            best = cos.argmax(axis=1)
            for i, c, v in zip(part, self.owner[best], cos[np.arange(len(part)), best].astype(float)):
                pred[i], score[i], rejected[i] = self.langs[c], min(1.0, max(0.0, v)), v < self.radius[c]
        return pred, score, rejected


def _clusters(rows: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    """Centroids by spherical k-means; starts are picked far apart, so no chance is in it."""
    start = [int((rows @ rows.mean(axis=0)).argmax())]
    near = rows @ rows[start[0]]
    while len(start) < min(k, len(rows)):
        start.append(int(near.argmin()))
        near = np.maximum(near, rows @ rows[start[-1]])
    at = rows[start]
    for _ in range(rounds):
        to = (rows @ at.T).argmax(axis=1)
        at = np.stack([ngrams.unit(rows[to == c].sum(axis=0)) if (to == c).any() else at[c] for c in range(len(at))])
    return at


def fit_model(samples: dict[str, list[str]], df: np.ndarray, n: int, centroids: int = CENTROIDS) -> Model:
    idf = ngrams.inverse(df, n)
    langs = sorted(samples)
    all_at, owner, radius = [np.zeros((0, WIDTH), np.float32)], [], []
    for k, lang in enumerate(langs):
        rows = ngrams.tf_idf(samples[lang], vector, idf)
        at = _clusters(rows, centroids)
        all_at.append(at)
        owner += [k] * len(at)
        radius.append(float(np.quantile((rows @ at.T).max(axis=1), RADIUS_QUANTILE)))
    return Model(idf, langs, np.concatenate(all_at).astype(np.float32), np.array(owner, int), np.array(radius))


def fit(train: DataFrame, sample_rows: int = SAMPLE_ROWS, centroids: int = CENTROIDS) -> Model:
    """Learn from ``train`` (text, lang): document counts over all its rows, centroids from the
    ``sample_rows`` different texts of smallest hash per language (a documented bound; the model is that bound
    times the languages, which are collected with it)."""
    train = train.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select("text", "lang")
    df, n = ngrams.document_counts(train, WIDTH, vector)
    # Copies count once.  A first cut by hash lets about twice sample_rows texts of each language through,
    # however many tasks; a language of few texts passes whole.
    hashed = train.withColumn("h", F.xxhash64("text"))
    texts = hashed.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("texts"))
    share = F.lit(2.0 * sample_rows + 100) / F.col("texts")
    passed = lookup(hashed, scratch(texts, "lang-texts"), ["lang"], F.col("h")).where((share >= 1) | share_below(F.col("h"), share))
    first = Window.partitionBy("lang").orderBy("h")
    sample = (passed.groupBy("lang", "h").agg(F.min("text").alias("text")).withColumn("r", F.row_number().over(first))
              .where(F.col("r") <= sample_rows).select("lang", "text").orderBy("lang", "text").collect())
    by_lang: dict[str, list[str]] = {}
    for r in sample:
        by_lang.setdefault(r["lang"], []).append(r["text"])
    return fit_model(by_lang, df, n, centroids)


def predict(docs: DataFrame, model: Model, text: str = "text", drop_text: bool = False) -> DataFrame:
    """``docs`` with ``lang_pred`` (string), ``score`` (cosine, 0 to 1) and ``rejected`` (boolean)."""
    docs, text = docs.drop(*RESULT), resolve(docs, text)
    kept = [c for c in docs.columns if not (drop_text and c == text)]
    shared = docs.sparkSession.sparkContext.broadcast(model)       # bounded: centroids x features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pred, score, rejected = shared.value.predict(b.column(b.schema.get_field_index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in kept]
                                             + [pa.array(pred, pa.string()), pa.array(score, pa.float64()), pa.array(rejected)],
                                             names=[*kept, *RESULT])

    types = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in kept] + ["lang_pred string, score double, rejected boolean"]))
