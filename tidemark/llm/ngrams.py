"""Hashed byte n-gram counts, document frequencies and TF-IDF rows, in numpy inside tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_MULTIPLY = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def hashed(a: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Bucket in [0, 2**bits) of every run of ``n`` bytes in ``a`` (uint8)."""
    if len(a) < n:
        return np.empty(0, np.int64)
    w = a.astype(np.uint32)
    h = w[:len(a) - n + 1] * _MULTIPLY[0]
    for j in range(1, n):
        h += w[j:len(a) - n + 1 + j] * _MULTIPLY[j]
    h ^= h >> np.uint32(15)
    h *= _MULTIPLY[1]
    return (h >> np.uint32(32 - bits)).astype(np.int64)


def document_counts(docs: DataFrame, dims: int, vector: Callable[[str | None], np.ndarray]) -> tuple[np.ndarray, int]:
    """(documents that have each feature, documents) over all rows of ``docs`` (column ``text``).

    Each task adds up its own rows and sends at most ``dims`` numbers on; the sums per feature are
    all that reaches the driver.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(dims, np.int64), 0
        for b in batches:
            for t in b.column(0):
                df += vector(t.as_py()) > 0
                n += 1
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(df[some], n))], names=["f", "n"])

    rows = docs.select("text").mapInArrow(run, "f long, n long").groupBy("f").agg(F.sum("n").alias("n")).collect()
    df, n = np.zeros(dims, np.int64), 0
    for r in rows:
        if r["f"] < 0:
            n = r["n"]
        else:
            df[r["f"]] = r["n"]
    return df, n


def inverse(df: np.ndarray, n: int) -> np.ndarray:
    """Smoothed inverse document frequency."""
    return np.log((1.0 + n) / (1.0 + df)).astype(np.float32) + np.float32(0.1)


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1 (zero rows stay zero)."""
    size = np.linalg.norm(rows, axis=-1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def tf_idf(texts: list[str | None], vector: Callable, idf: np.ndarray) -> np.ndarray:
    """Unit rows of log(1 + count) * idf."""
    if not texts:
        return np.zeros((0, len(idf)), np.float32)
    return unit(np.log1p(np.stack([vector(t) for t in texts]).astype(np.float32)) * idf)
