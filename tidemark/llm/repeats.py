"""Removal of long repeated byte strings: counted segments, interleave refinement of the rest (operator 7).

A byte goes if a ``length``-byte string that covers it starts anywhere else, in the same text or
another.  No Burrows-Wheeler transform of a shard is built and none are merged: that would take
``length`` passes over all text.  Only text that can be repeated is ordered, and only as far as it matters:

1. **Anchors.**  Every window of ``length`` bytes is anchored at the 64-byte gram of least hash in
   it (leftmost of equals).  Equal windows have equal grams at equal offsets.  Windows in a row with
   one anchor form a segment; a segment travels as (anchor hash, content hash), not as text.
2. **Counting.**  Anchors that come once cannot repeat.  Segments that come twice or more are
   repeated whole (exact copies end here, as one counted row).  What is left are anchors with
   several different segments, of which some come once.
3. **Merging.**  The members of an anchor, from whatever shards their texts lie in, are aligned at
   it.  Starting from the order they arrive in, the interleave of their suffixes is refined column
   by column from the right: a stable partition by the byte in front (one Burrows-Wheeler step),
   all anchors of a block at once.  The column up to which neighbours agree (their common prefix) is
   carried along: neighbours that stay neighbours keep it, others take the least between them.
   No suffix is ever sorted again.  Where a suffix agrees with a neighbour for ``length`` bytes, its
   window is repeated.
4. Repeated windows go back to the texts, which are cut and hashed.

Work and rows grow with the text.  A segment is shorter than twice ``length``.  An anchor with more
than ``HOT`` different segments is not merged in one task: its windows are counted by 128-bit hash,
dealt out by window (exact as well).  Beside the batch itself, memory does not follow the size of
batches or texts, which are looked at in blocks; merging takes a few times its segments' bytes.  Texts
are identified by the first 128 bits of their SHA-256, segments by 128-bit hash.

Defined cases: null text is empty; texts shorter than ``length`` keep everything; repeated rows,
also with the same or a null doc_id, are copies of each other; an empty table gives no rows; other
columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch

LENGTH = 400
GRAM = 64
HOT = 50_000               # different segments of one anchor merged in one task at most
BLOCK_SEGMENTS = 20_000    # segments merged at once
BLOCK_BYTES = 500_000      # text looked at in one numpy call, and one piece more at most
_PIECE = 1 << 20           # of a longer text
_LOW = np.uint64((1 << 24) - 1)
_TABLE = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


# ---- anchors -------------------------------------------------------------------------------

def gram_hashes(a: np.ndarray, gram: int) -> np.ndarray:
    """Hash of every run of ``gram`` bytes (a power of two), by doubling."""
    h, width = _TABLE[a], 1
    while width < gram:
        h = h[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of ``w`` values: block prefixes and suffixes meet."""
    n = len(v)
    k = -(-n // w)
    padded = np.full(k * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = v
    blocks = padded.reshape(k, w)
    before = np.minimum.accumulate(blocks, axis=1).ravel()
    after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(after[:n - w + 1], before[w - 1:n])


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Segments of some texts: ``doc`` number, ``at`` (first window), ``n`` (windows), ``a`` (anchor
    minus first window), ``key`` (anchor hash), and the content hash ``s1, s2``."""
    pieces, size, out = [], 0, []
    for d, t in enumerate(texts):
        for lo in range(0, max(0, len(t) - length + 1), _PIECE):      # windows starting in [lo, lo + piece)
            pieces.append((d, lo, t[lo:lo + _PIECE + length - 1] if len(t) > _PIECE else t))
            size += len(pieces[-1][2])
            if size >= BLOCK_BYTES:
                out.append(_segments(pieces, length, gram))
                pieces, size = [], 0
    if pieces:
        out.append(_segments(pieces, length, gram))
    names = {"doc": np.int64, "at": np.int64, "n": np.int64, "a": np.int64, "key": np.int64, "s1": np.int64, "s2": np.int64}
    return {c: np.concatenate([o[c] for o in out]) if out else np.empty(0, t) for c, t in names.items()}


def _segments(pieces: list[tuple[int, int, bytes]], length: int, gram: int) -> dict[str, np.ndarray]:
    data = b"".join(p[2] for p in pieces)
    sizes = np.array([len(p[2]) for p in pieces])
    ends = np.cumsum(sizes)
    h = gram_hashes(np.frombuffer(data, np.uint8), gram)
    least = _sliding_min((h & ~_LOW) | np.arange(len(h), dtype=np.uint64), length - gram + 1)
    anchor = (least & _LOW).astype(np.int64)
    start = np.concatenate([np.arange(e - s, e - length + 1) for e, s in zip(ends, sizes)])   # windows within a piece
    mine = anchor[start]
    cut = np.flatnonzero((mine[1:] != mine[:-1]) | (start[1:] != start[:-1] + 1)) + 1
    first = np.concatenate(([0], cut))
    count = np.diff(np.concatenate((first, [len(start)])))
    at, anchor = start[first], mine[first]
    digests = b"".join([xxhash.xxh3_128_digest(data[i:j]) for i, j in zip(at.tolist(), (at + count + length - 1).tolist())])
    s = np.frombuffer(digests, np.int64).reshape(-1, 2)
    piece = np.searchsorted(ends, at, side="right")
    shift = np.array([p[1] for p in pieces]) - (ends - sizes)
    return {"doc": np.array([p[0] for p in pieces])[piece], "at": at + shift[piece], "n": count, "a": anchor - at,
            "key": h[anchor].view(np.int64), "s1": s[:, 0], "s2": s[:, 1]}


# ---- merging -------------------------------------------------------------------------------

def merge(group: np.ndarray, a: np.ndarray, texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per segment, which of its windows start another segment of its group too.

    ``group`` numbers the anchors (ascending), ``a`` is the anchor's place in each segment.
    """
    r, sizes = len(texts), np.fromiter(map(len, texts), np.int64, len(texts))
    left, right = int(a.max()), int((sizes - a).max())
    width = left + right
    begin, end = left - a, left - a + sizes                       # a segment's columns, aligned at the anchor
    padded = b"".join(x for i, j, t in zip(begin.tolist(), end.tolist(), texts) for x in (bytes(i), t, bytes(width - j)))
    columns = np.ascontiguousarray(np.frombuffer(padded, np.uint8).reshape(r, width).T)
    del padded
    order = np.arange(r)                                          # the interleave: arrival order
    same = np.concatenate(([False], group[1:] == group[:-1]))     # may agree with the one before
    agree = np.where(same, width, -1)                             # column up to which it does
    repeated = np.zeros((r, max(0, width - length + 1)), bool)
    base = group.astype(np.int64) * 512
    for col in range(width - 1, -1, -1):
        byte = np.where((begin <= col) & (col < end), columns[col], 256)     # 256: no byte
        symbol = base[order] + byte[order]                        # by group first, so groups stay apart
        if (symbol[1:] < symbol[:-1]).any():
            step = np.argsort(symbol, kind="stable")
            symbol, order = symbol[step], order[step]
            # neighbours now: the least agreement between their old places
            lo, hi = step[:-1] + 1, step[1:] + 1
            pair = np.flatnonzero((symbol[1:] == symbol[:-1]) & (symbol[1:] % 512 != 256))
            kept = np.full(r, -1)
            next_to = lo[pair] + 1 == hi[pair]
            kept[pair[next_to] + 1] = agree[lo[pair[next_to]]]
            far = pair[~next_to]
            if len(far):
                bounds = np.empty(2 * len(far), np.int64)
                bounds[0::2], bounds[1::2] = lo[far], hi[far]
                kept[far + 1] = np.minimum.reduceat(np.append(agree, -1), bounds)[0::2]
        else:
            equal = np.concatenate(([False], (symbol[1:] == symbol[:-1]) & (symbol[1:] % 512 != 256)))
            kept = np.where(equal, agree, -1)
        # -1 so far: it differs here, so it agrees up to this column (if in the same group)
        agree = np.where(kept >= 0, kept, np.where(same, col, -1))
        if col + length <= width:
            long_ = agree >= col + length
            if long_.any():
                repeated[order, col] = long_ | np.append(long_[1:], False)
    return [repeated[i, left - a[i]:left - a[i] + max(0, sizes[i] - length + 1)] for i in range(r)]


def _runs(flags: np.ndarray) -> list[dict]:
    """[lo, hi) of the windows flagged."""
    edge = np.flatnonzero(np.diff(np.concatenate(([False], flags, [False])).astype(np.int8)))
    return [{"lo": int(i), "hi": int(j)} for i, j in zip(edge[0::2], edge[1::2])]


_RUN = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
_SPAN = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))


def _merge_partition(length: int):
    """Rows (key, s1, s2, n, a, text) by key: runs of repeated windows of segments that come once."""
    def flush(rows: list[tuple]) -> pa.RecordBatch:
        numbers: dict = {}
        group = np.array([numbers.setdefault(r[0], len(numbers)) for r in rows])
        flags = merge(group, np.array([r[4] for r in rows]), [r[5] for r in rows], length)
        mine = [(r, _runs(f)) for r, f in zip(rows, flags) if r[3] == 1 and f.any()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r, _ in mine], pa.int64()) for k in range(3)]
                                          + [pa.array([x for _, x in mine], _RUN)], names=["key", "s1", "s2", "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, last = [], None                     # ``rows``: whole anchors and the beginning of the last one
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if last is not None and row[:3] == last[:3]:
                    continue                      # the same segment from a copy of its text
                if len(rows) >= BLOCK_SEGMENTS and row[0] != last[0]:
                    yield flush(rows)
                    rows = []
                rows.append(row)
                last = row
        if rows:
            yield flush(rows)

    return run


# ---- the operator --------------------------------------------------------------------------

def _binary(batch: pa.RecordBatch, name: str) -> list[bytes]:
    return [t or b"" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about ``BLOCK_BYTES`` of ``data``, so no whole batch becomes Python objects."""
    for b in batches:
        sizes = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index("data"))), 0)
        block = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64) // BLOCK_BYTES
        for lo, hi in pairwise([0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), b.num_rows]):
            yield b.slice(lo, hi - lo)


def _cut_rows(length: int, gram: int):
    """(d1, d2, data) -> rows of segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            d1, d2 = b.column(0).to_numpy(), b.column(1).to_numpy()
            s = segments(_binary(b, "data"), length, gram)
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1[s["doc"]]), pa.array(d2[s["doc"]]), pa.array(s["at"].astype(np.int32)), pa.array(s["n"].astype(np.int32)),
                 pa.array(s["key"]), pa.array(s["s1"]), pa.array(s["s2"])], names=["d1", "d2", "at", "n", "key", "s1", "s2"])

    return run


_WANT = "key long, s1 long, s2 long, n long, a int, text binary, hot boolean"


def _fetch(length: int, gram: int):
    """(data, want) -> the wanted segments' bytes; ``want``: (at, key, s1, s2, times, hot)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            out = []
            for data, want in zip(_binary(b, "data"), b.column(b.schema.get_field_index("want"))):
                s = segments([data], length, gram)
                where = {int(at): k for k, at in enumerate(s["at"])}
                for w in want.as_py():
                    k = where[w["at"]]
                    at, n = int(s["at"][k]), int(s["n"][k])
                    out.append((w["key"], w["s1"], w["s2"], w["times"], int(s["a"][k]), data[at:at + n + length - 1], w["hot"]))
                    if len(out) >= 2000:
                        yield _wanted(out)
                        out = []
            yield _wanted(out)

    return run


def _wanted(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64()] * 4 + [pa.int32(), pa.binary(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)],
                                      names=["key", "s1", "s2", "n", "a", "text", "hot"])


def _hot_windows(fetched: DataFrame, length: int) -> DataFrame:
    """The same answer for anchors with very many segments: windows counted by their hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                t = r["text"]
                k = len(t) - length + 1
                w = np.frombuffer(b"".join(xxhash.xxh3_128_digest(t[j:j + length]) for j in range(k)), np.int64).reshape(-1, 2)
                full = lambda c: pa.array(np.full(k, r[c], np.int64))
                yield pa.RecordBatch.from_arrays([full("key"), full("s1"), full("s2"), full("n"), pa.array(np.arange(k, dtype=np.int32)),
                                                  pa.array(w[:, 0].copy()), pa.array(w[:, 1].copy())], names=["key", "s1", "s2", "n", "j", "w1", "w2"])

    segs = fetched.where("hot").drop("hot").dropDuplicates(["key", "s1", "s2"])
    rows = scratch(segs.select("key", "s1", "s2", "n", "text").mapInArrow(run, "key long, s1 long, s2 long, n long, j int, w1 long, w2 long"), "repeat-hot")
    twice = rows.groupBy("w1", "w2").count().where("count > 1").select("w1", "w2")
    hits = rows.where("n = 1").join(twice, ["w1", "w2"], "left_semi")
    runs = F.transform(F.array_sort(F.collect_list("j")), lambda j: F.struct(j.alias("lo"), (j + 1).alias("hi")))
    return hits.groupBy("key", "s1", "s2").agg(runs.alias("runs"))


def _identified(docs: DataFrame) -> DataFrame:
    """(doc_id, data, sha, d1, d2): bytes, SHA-256 and its first 128 bits as two longs."""
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    half = lambda k: F.conv(F.substring("sha", k, 16), 16, -10).cast("long")
    return (docs.select("doc_id", data.alias("data")).withColumn("sha", F.sha2("data", 256))
            .withColumn("d1", half(1)).withColumn("d2", half(17)))


def _finish(length: int):
    """(doc_id, data, sha, found) -> the result row; ``found``: (at, runs) of segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _parts(batches):
            found = b.column(b.schema.get_field_index("found"))
            out = []
            for data, sha, f in zip(_binary(b, "data"), b.column(b.schema.get_field_index("sha")).to_pylist(), found):
                f = f.as_py()
                spans = sorted((s["at"] + r["lo"], s["at"] + r["hi"] - 1 + length) for s in f for r in s["runs"]) if f else []
                gone: list[list[int]] = []
                for i, j in spans:
                    if gone and i <= gone[-1][1]:
                        gone[-1][1] = max(gone[-1][1], j)
                    else:
                        gone.append([i, j])
                if gone:
                    edges = [0, *[x for g in gone for x in g], len(data)]
                    sha = hashlib.sha256(b"".join(data[i:j] for i, j in zip(edges[0::2], edges[1::2]))).hexdigest()
                out.append((len(data), sum(j - i for i, j in gone), len(gone), sha, [{"lo": i, "hi": j} for i, j in gone]))
            cols = list(zip(*out)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), *[pa.array(cols[k], pa.int64()) for k in range(3)], pa.array(cols[3], pa.string()),
                 pa.array(cols[4], _SPAN)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])

    return run


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed) per row of ``docs``."""
    if gram & (gram - 1) or not 0 < gram <= length:
        raise ValueError("gram must be a power of two, at most length")
    whole = _identified(docs)
    cut = scratch(whole.where(F.octet_length("data") >= length).select("d1", "d2", "data")
                  .mapInArrow(_cut_rows(length, gram), "d1 long, d2 long, at int, n int, key long, s1 long, s2 long"), "repeat-segments")
    # anchors that come more than once, and their segments
    anchors = (cut.groupBy("key").agg(F.count("*").alias("t"), F.min("s1").alias("a"), F.max("s1").alias("b"))
               .where("t > 1").select("key", (F.col("a") != F.col("b")).alias("several")))
    # Written first: the join then has its own exchange, and adaptive execution splits a very common anchor.
    near = scratch(cut.join(scratch(anchors, "repeat-anchors"), "key"), "repeat-candidates")
    kinds = (near.groupBy("key", "s1", "s2", "several")
             .agg(F.count("*").alias("times"), F.max("n").alias("n"), F.min(F.struct("d1", "d2", "at")).alias("where")))
    kinds = scratch(kinds, "repeat-kinds")
    whole_run = F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi")))
    copies = kinds.where("times > 1").select("key", "s1", "s2", whole_run.alias("runs"))
    # anchors with several segments of which one at least comes once
    open_ = (kinds.where("several").groupBy("key").agg(F.count("*").alias("m"), F.min("times").alias("least"))
             .where("m > 1 and least = 1").select("key", (F.col("m") > HOT).alias("hot")))
    wanted = (kinds.where("several").join(open_, "key")
              .groupBy("where.d1", "where.d2")
              .agg(F.collect_list(F.struct(F.col("where.at").alias("at"), "key", "s1", "s2", "times", "hot")).alias("want")))
    fetched = scratch(whole.select("d1", "d2", "data").join(wanted.hint("shuffle_hash"), ["d1", "d2"]).select("data", "want")
                      .mapInArrow(_fetch(length, gram), _WANT), "repeat-fetched")
    merged = (fetched.where("not hot").drop("hot").repartition("key").sortWithinPartitions("key", "s1", "s2")
              .mapInArrow(_merge_partition(length), "key long, s1 long, s2 long, runs array<struct<lo: int, hi: int>>"))
    found = copies.unionByName(merged)
    if not open_.where("hot").isEmpty():
        found = found.unionByName(_hot_windows(fetched, length))
    by_text = (near.select("d1", "d2", "at", "key", "s1", "s2").join(found, ["key", "s1", "s2"])
               .groupBy("d1", "d2").agg(F.collect_set(F.struct("at", "runs")).alias("found")))
    return (whole.join(by_text.hint("shuffle_hash"), ["d1", "d2"], "left").select("doc_id", "data", "sha", "found")
            .mapInArrow(_finish(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
                                         "removed array<struct<lo: long, hi: long>>"))


ORACLE = """
WITH n AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS t,
                  CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
w AS (SELECT rid, i, md5(t[i + 1:i + 400]) AS k
      FROM (SELECT rid, t, unnest(range(0, n - 399)) AS i FROM n WHERE n >= 400)),
r AS (SELECT rid, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
g AS (SELECT rid, i, sum(CASE WHEN p IS NULL OR i > p + 400 THEN 1 ELSE 0 END) OVER (PARTITION BY rid ORDER BY i) AS island
      FROM (SELECT rid, i, lag(i) OVER (PARTITION BY rid ORDER BY i) AS p FROM r)),
s AS (SELECT rid, min(i) AS a, max(i) + 400 AS b FROM g GROUP BY rid, island),
cuts AS (SELECT rid, a, b, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS e FROM s),
kept AS (SELECT n.rid, CAST(sum(b - a) AS BIGINT) AS gone, count(*) AS spans,
                string_agg(CASE WHEN a > e THEN hex(t[e + 1:a]) ELSE '' END, '' ORDER BY a)
                || CASE WHEN max(b) < any_value(n.n) THEN hex(any_value(t)[max(b) + 1:any_value(n.n)]) ELSE '' END AS h
         FROM cuts JOIN n USING (rid) GROUP BY n.rid)
SELECT n.doc_id, n.n AS n_bytes, coalesce(kept.gone, 0) AS n_removed, coalesce(kept.spans, 0) AS n_spans,
       CASE WHEN kept.rid IS NULL THEN sha256(n.t) ELSE sha256(unhex(kept.h)) END AS kept_sha256
FROM n LEFT JOIN kept USING (rid)
"""
