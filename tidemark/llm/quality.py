"""Quality classifier by nearest-neighbour voting on latent-semantic vectors (operator 8).

Features of a whole text: hashed byte trigrams, and style terms (share of upper case, of marks, of
repeated words and lines, of words like the one before and of one byte, mean word length, size) as
buckets.  TF-IDF with document counts
over all documents; truncated SVD of a bounded labelled sample gives the latent space.  The
sample's unit vectors (``sample_rows`` x ``dims``, a fixed bound) go to every task; each document's
exact cosine with all of them is one blocked matrix product, and the ``neighbours`` most similar
vote with their similarity.

Only rows of the training fold give labels.  Labels, lang, source and doc_id are no inputs of a
score.  Defined cases: null and empty texts are scored by their style terms; rows without a
label, with a null label or a null doc_id are not learned from; ties in similarity go to the
neighbour earlier in sample order (by hash); without any labelled row the score is 1.0
(nothing speaks against a text); repeated rows score alike; an empty table gives no rows; input
columns ``score`` and ``predicted`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import ngrams
from tidemark.llm.common import bounded_sample, resolve

BITS, STYLE = 12, 64
WIDTH = (1 << BITS) + STYLE
SAMPLE_ROWS = 3000         # labelled rows learned from
DIMS = 64
NEIGHBOURS = 5             # at every size of the sample (all of a smaller one)
BLOCK = 256                # documents per matrix product
STYLE_WEIGHT = 0.35        # of each style term, beside trigrams of length 1
_IS_UPPER = np.array([65 <= c <= 90 for c in range(256)], np.uint8)
_IS_MARK = np.array([33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126 for c in range(256)], np.uint8)


def vector(text: str | None) -> np.ndarray:
    """Trigram counts and style buckets of a whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    a = np.frombuffer(data, np.uint8)
    out = np.zeros(WIDTH, np.int64)
    out[:1 << BITS] = np.bincount(ngrams.hashed(a, 3, BITS), minlength=1 << BITS)
    n, w, lines = max(1, len(a)), data.split(), [x for x in data.split(b"\n") if x]
    m = max(1, len(w))
    shares = (_IS_UPPER[a].sum() / n, _IS_MARK[a].sum() / n, 1 - len(set(w)) / m, 1 - len(set(lines)) / max(1, len(lines)),
              min(1.0, n / m / 16), min(1.0, np.log1p(len(w)) / 10), sum(map(eq, w[1:], w)) / m, list(map(len, w)).count(1) / m)
    for k, s in enumerate(shares):
        out[(1 << BITS) + k * 8 + min(7, int(s ** 0.5 * 8))] = 1
    return out


def weighted(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    """Feature rows: TF-IDF of the trigrams at length 1, then the style terms."""
    counts = np.stack([vector(t) for t in texts]).astype(np.float32) if texts else np.zeros((0, WIDTH), np.float32)
    grams = ngrams.unit(np.log1p(counts[:, :1 << BITS]) * idf[:1 << BITS])
    return np.concatenate([grams, counts[:, 1 << BITS:] * np.float32(STYLE_WEIGHT)], axis=1)


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray       # features x dims
    points: np.ndarray     # sample x dims, unit rows
    labels: np.ndarray     # 0 / 1
    neighbours: int = NEIGHBOURS

    def project(self, texts: list[str | None]) -> np.ndarray:
        return ngrams.unit(weighted(texts, self.idf) @ self.axes).astype(np.float32)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest neighbours."""
        if not len(self.labels) or not texts:
            return np.ones(len(texts))
        out = []
        for i in range(0, len(texts), BLOCK):
            near = self.project(texts[i:i + BLOCK]) @ self.points.T
            k = min(self.neighbours, near.shape[1])
            edge = -np.partition(-near, k - 1, axis=1)[:, k - 1:k]
            above, tied = near > edge, near == edge
            room = k - above.sum(axis=1, keepdims=True)
            mine = above | (tied & (np.cumsum(tied, axis=1) <= room))
            w = np.where(mine, np.maximum(near, 0), 0).astype(np.float64)
            total = w.sum(axis=1)
            out.append(np.where(total > 0, w @ self.labels / np.where(total > 0, total, 1), self.labels.mean()))
        return np.clip(np.concatenate(out), 0, 1)


def fit_model(texts: list[str | None], labels: list[int], df: np.ndarray, n: int, dims: int = DIMS,
              neighbours: int = NEIGHBOURS, seed: int = 8) -> Model:
    """Latent space and labelled points from a sample (randomised truncated SVD)."""
    idf = ngrams.inverse(df, n)
    rows = weighted(texts, idf)
    y = np.array(labels, np.float64)
    if not len(y):
        return Model(idf, np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), y, neighbours)
    rng = np.random.default_rng(seed)
    k = min(dims, *rows.shape)
    basis = rows.T @ (rows @ rng.normal(size=(WIDTH, min(k + 16, len(y)))).astype(np.float32))
    for _ in range(3):
        basis = rows.T @ (rows @ np.linalg.qr(basis)[0])
    q = np.linalg.qr(basis)[0]
    _, _, vt = np.linalg.svd(rows @ q, full_matrices=False)
    axes = (q @ vt[:k].T).astype(np.float32)
    return Model(idf, axes, ngrams.unit(rows @ axes).astype(np.float32), y, neighbours)


def fit(docs: DataFrame, labels: DataFrame, training: "object", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on the ``sample_rows`` labelled rows of smallest hash among those where ``training`` (a
    condition on doc_id) holds; document counts are over all of ``docs``."""
    df, n = ngrams.document_counts(docs, WIDTH, vector)
    known = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & training).select("doc_id", "quality"))
    # at most sample_rows ids and labels: a proven bound for the broadcast
    chosen = bounded_sample(known, ["doc_id", "quality"], sample_rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = bounded_sample(texts, ["doc_id", "quality", "text"], sample_rows).collect()
    return fit_model([r["text"] for r in sample], [r["quality"] for r in sample], df, n)


def score(docs: DataFrame, model: Model, text: str = "text", drop_text: bool = False, to: str = "score") -> DataFrame:
    """``docs`` with the score in column ``to`` (double)."""
    docs, text = docs.drop(to), resolve(docs, text)
    kept = [c for c in docs.columns if not (drop_text and c == text)]
    shared = docs.sparkSession.sparkContext.broadcast(model)       # bounded: sample_rows x dims and features x dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(b.schema.get_field_index(text)).to_pylist()
            yield pa.RecordBatch.from_arrays([b.column(b.schema.get_field_index(c)) for c in kept]
                                             + [pa.array(shared.value.scores(texts), pa.float64())], names=[*kept, to])

    types = dict(docs.dtypes)
    return docs.mapInArrow(run, ", ".join([f"`{c}` {types[c]}" for c in kept] + [f"`{to}` double"]))


def keep_good(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """``docs`` without the documents scored under ``least``; columns as they are."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = f"c{names.index(resolve(docs, 'text'))}"
    return score(plain, model, text=text).where(F.col("score") >= least).drop("score").toDF(*names)
