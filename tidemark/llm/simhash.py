"""SimHash near-duplicates by anchor-point covering (operator 5).

Fingerprint: lower-case A-Z, words between ASCII white space, ``k``-word shingles with repeats;
a bit is set if it is set in over half of the shingles' XXH64 (seed 42).

Anchors: two fingerprints at most ``max_bits`` apart differ by at most ``max_bits // 2`` in one of
their 32-bit halves, so each half is covered on its own.  The code words of the [31, 26] Hamming
code, with one free bit, are the anchors of a half: every half is within 1 of one (its home,
covering radius 1).  A fingerprint goes to every anchor within 1 + ``max_bits // 2``; then any
two that are to be linked meet at the home of either.  Per anchor the homes are compared with
all members by full 64-bit distance.  (One code over all 64 bits would need thousands of copies
per fingerprint for the same promise; two halves need 34.)

Links leave a task as stars of what is connected there, never as all pairs; components are found
over distinct fingerprints, so groups of exact copies are one node.  An anchor with many homes is
dealt out once more by the four bytes of the other half: at most ``max_bits < 4`` bits differ, so
two fingerprints to be linked agree in one of those bytes at least.

Defined cases: null, empty and white-space texts have fingerprint 0 and are linked like any other;
null ids take part and never name a component (a group with null ids only has a null
component_id); repeated rows stay repeated; an empty table gives an empty result; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fresh, resolve, scratch
from tidemark.llm.graph import components

HOT_HOMES = 2048          # homes at one anchor beyond which it is dealt out by the other half's bytes
PAIRS_AT_ONCE = 2_000_000  # compared in one numpy call; bounds a task's memory
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_PLACES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(text: str | None, k: int = 3) -> int:
    """The 64-bit fingerprint of one whole text, as an unsigned number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()   # bytes: ASCII only
    if not words:
        return 0
    n = max(1, len(words) - k + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    ends = ends[min(k, len(words)) - 1:]
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[i:j], 42) for i, j in zip(starts.tolist(), ends.tolist())], dtype="<u8")
    per_byte = np.bincount((hashes.view(np.uint8).reshape(-1, 8) + _PLACES).ravel(), minlength=2048)
    ones = (per_byte.reshape(8, 256) @ _BITS).ravel()              # set bits by position, low first
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(docs: DataFrame, k: int = 3, text: str = "text", to: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint as a signed long in column ``to`` (replaced if there)."""
    docs, text = docs.drop(to), resolve(docs, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = b.schema.get_field_index(text)
            fps = np.array([fingerprint(t.as_py(), k) for t in b.column(at)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(fps, pa.int64())], names=[*b.schema.names, to])

    schema = ", ".join([f"`{n}` {t}" for n, t in docs.dtypes] + [f"`{to}` long"])
    return docs.mapInArrow(run, schema)


def _masks(max_bits: int) -> list[list[int]]:
    """Per syndrome of the Hamming code: every change of a half that leads to an anchor within
    reach, the shortest (the way home) first."""
    reach = 1 + max_bits // 2
    out: list[list[int]] = [[] for _ in range(32)]
    level = {0}
    for weight in range(reach + 1):
        for m in sorted(level):
            s = 0
            for j in range(31):                      # bit 31 is free: it is in no parity check
                if m >> j & 1:
                    s ^= j + 1
            out[s].append(m)
        level = {m | 1 << j for m in level for j in range(32) if not m >> j & 1}
    return out


def _syndrome(half: Column) -> Column:
    s = F.lit(0)
    for i in range(5):
        check = sum(1 << j for j in range(31) if (j + 1) >> i & 1)
        s = s + (F.bit_count(half.bitwiseAND(F.lit(check))) % 2) * (1 << i)
    return s


def anchored(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(anchor, fp, home) rows: every fingerprint at every anchor of either half within reach."""
    table = F.array(*[F.array(*[F.lit(m).cast("long") for m in ms]) for ms in _masks(max_bits)])
    half = F.expr("shiftrightunsigned(fp, side * 32)").bitwiseAND(F.lit(0xFFFFFFFF))
    rows = (fps.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("side"))
            .withColumn("half", half).withColumn("ways", F.element_at(table, _syndrome(F.col("half")) + 1)))
    return (rows.select("fp", "side", "half", F.posexplode("ways").alias("nth", "way"))
            .select((F.col("half").bitwiseXOR(F.col("way")) + F.shiftleft(F.col("side").cast("long"), 32))
                    .alias("anchor"), "fp", (F.col("nth") == 0).alias("home")))


def _spread_hot(members: DataFrame) -> DataFrame:
    """Deal anchors with many homes out by the bytes of the other half (exact, four copies)."""
    hot = scratch(members.where("home").groupBy("anchor").count().where(F.col("count") > HOT_HOMES)
                  .select("anchor", F.lit(True).alias("hot")), "simhash-hot")
    byte = F.expr("shiftrightunsigned(fp, if(anchor < 4294967296, 32, 0) + nth * 8) & 255")
    nths = F.when(F.col("hot"), F.array(*[F.lit(i) for i in range(4)])).otherwise(F.array(F.lit(-1)))
    return (members.join(hot, "anchor", "left").select("anchor", "fp", "home", F.explode(nths).alias("nth"))
            .withColumn("part", F.when(F.col("nth") >= 0, F.col("nth") * 256 + byte).otherwise(F.lit(-1)).cast("int"))
            .select("anchor", "part", "fp", "home"))


def _stars(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links (x, y) as links of every node to the smallest one connected to it here."""
    nodes, at = np.unique(np.concatenate([x, y]), return_inverse=True)
    i, j = at[:len(x)], at[len(x):]
    lab = np.arange(len(nodes))
    while True:
        low = np.minimum(lab[i], lab[j])
        if (lab[i] == low).all() and (lab[j] == low).all():
            break
        np.minimum.at(lab, lab[i], low)
        np.minimum.at(lab, lab[j], low)
        lab = lab[lab]
        np.minimum.at(lab, i, low)
        np.minimum.at(lab, j, low)
    low = nodes[lab]
    far = low != nodes
    return low[far], nodes[far]


def _compare(max_bits: int):
    def pairs(homes: np.ndarray, lo: np.ndarray, n: np.ndarray, fp: np.ndarray):
        """homes[i] against fp[lo[i]:lo[i] + n[i]], in slices of bounded size."""
        start, sizes = 0, np.cumsum(n)
        while start < len(homes):
            stop = max(start + 1, int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + PAIRS_AT_ONCE)))
            part = n[start:stop]
            if stop == start + 1 and part[0] > PAIRS_AT_ONCE:        # one home, a very long member list
                spans = [(lo[start] + s, min(PAIRS_AT_ONCE, part[0] - s)) for s in range(0, int(part[0]), PAIRS_AT_ONCE)]
                todo = [(np.full(m, homes[start]), fp[s:s + m]) for s, m in spans]
            else:
                at = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part) + np.repeat(lo[start:stop], part)
                todo = [(np.repeat(homes[start:stop], part), fp[at])]
            for x, y in todo:
                near = np.bitwise_count(x ^ y) <= max_bits
                near &= x != y
                if near.any():
                    yield _stars(x[near].view(np.int64), y[near].view(np.int64))
            start = stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, old = None, np.empty(0, np.uint64)      # homes of the last group, which may go on
        for b in batches:
            if not b.num_rows:
                continue
            anchor, part = b.column(0).to_numpy(), b.column(1).to_numpy()
            fp, home = b.column(2).to_numpy().view(np.uint64), b.column(3).to_numpy(zero_copy_only=False)
            new = np.flatnonzero((anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])) + 1
            lo = np.concatenate(([0], new))
            n = np.diff(np.concatenate((lo, [len(fp)])))
            if key == (anchor[0], part[0]) and len(old):             # homes come first in a group
                for a, c in pairs(old, np.zeros(len(old), np.int64), np.full(len(old), n[0]), fp):
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])
            group = np.repeat(np.arange(len(lo)), n)
            mine = np.flatnonzero(home & (n[group] > 1))
            for a, c in pairs(fp[mine], lo[group[mine]], n[group[mine]], fp):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(c)], names=["a", "b"])
            last = fp[lo[-1]:][home[lo[-1]:]]
            old = np.concatenate([old, last]) if key == (anchor[-1], part[-1]) and len(lo) == 1 else last
            key = (anchor[-1], part[-1])

    return run


def link(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column ``fp``) at most ``max_bits`` apart.

    Not every pair: stars that have the same components as all pairs.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("max_bits must be 0 to 3: hot anchors are dealt out by four bytes")
    members = _spread_hot(anchored(fps, max_bits))
    dealt = members.repartition("anchor", "part").sortWithinPartitions("anchor", "part", F.col("home").desc())
    return dealt.mapInArrow(_compare(max_bits), "a long, b long")


def label(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(fp, root) for the distinct values of ``fp``: one root per component."""
    distinct = fps.select("fp").distinct()
    roots = components(link(distinct, max_bits)).select(F.col("id").alias("fp"), "root")
    return distinct.join(roots, "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable over links."""
    rows = scratch(with_fingerprints(docs.select("doc_id", "text"), k).select("doc_id", "fp"), "simhash-fp")
    ids = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    by_fp = ids.join(label(rows, max_bits), "fp")
    least = by_fp.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = by_fp.join(least, "root").select("fp", "component_id")
    return rows.join(named, "fp")


def keep_one(docs: DataFrame, k: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id (null last), ties by content.

    Rows equal in every column are one document.
    """
    names, fp, mark = docs.columns, fresh(docs, "_fp"), fresh(docs, "_row")
    row = F.xxhash64(*[F.col(f"`{c}`") for c in names])
    rows = scratch(with_fingerprints(docs, k, to=fp).withColumn(mark, row), "simhash-docs")
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col(mark).alias("r"),
                     F.col(fp).alias("f"))
    firsts = rows.groupBy(F.col(fp).alias("fp")).agg(F.min(order).alias("first"))
    won = (firsts.join(label(firsts, max_bits), "fp").groupBy("root").agg(F.min("first").alias("first"))
           .select(F.col("first.f").alias(fp), F.col("first.r").alias(mark)))
    return rows.join(won, [fp, mark], "left_semi").dropDuplicates([fp, mark]).select(*[f"`{c}`" for c in names])
