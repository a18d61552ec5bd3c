"""Embedding near-duplicates by sharded small-world graphs (operator 4).

1. Equal vectors are one node (with a count), so groups of exact copies cost one search.
2. Nodes are dealt to shards by hash; each shard's graph is built in a task and written.  A shard
   has at most about ``SHARD_ROWS`` nodes whatever the table's size.
3. Every node queries every shard, in blocks (block x shard is a task's unit).  A block first
   audits itself: up to ``AUDIT_QUERIES`` of its queries are compared with all of the shard, and the
   beam is widened until those not in dense groups reach ``AUDIT_RECALL`` of their links and, where the
   nearest node is near the threshold or above, ``AUDIT_NEAREST`` of their nearest nodes.  Queries whose beam comes back full of
   links search again with a wider one; past ``MOST_BEAM`` (a dense group) they are answered
   by blocked products with the whole shard, so no group is cut off.
4. Found pairs are kept if their cosine, computed in double precision from the stored numbers, is
   at least the threshold.  A task sends on the links its searches found, counts for the queries
   answered by products (not their pairs) and a spanning forest of all its links; components come
   from the forest.

``n_links`` counts a link for both ends, whichever of the two searches found it.

Defined cases: vectors that are null, empty, zero or hold null or non-finite numbers have no links
and are their own component; vectors of different length never link; repeated rows are links of
each other like any equal vectors; null vec_ids take part and never name a component;
an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import scratch
from tidemark.llm.graph import components
from tidemark.llm.hnsw import Graph
from tidemark.llm.simhash import _stars

THRESHOLD = 0.9
SHARDS = 8                 # at least
SHARD_ROWS = 200_000       # nodes per shard beyond that: an index of some 200 MB at 64 numbers
BLOCKS = 3                 # blocks of queries, at least
BLOCK_ROWS = 100_000       # queries per block beyond that; a shard's index is sent once per block
BEAM, MOST_BEAM = 32, 256
AUDIT_QUERIES, AUDIT_RECALL = 512, 0.99
AUDIT_NEAREST, AUDIT_NEAR = 0.9, 0.05   # judged where the nearest node is no farther below the threshold
_SLACK = 1e-4              # float32 similarities this far below the threshold are checked too


def nodes_of(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): every row with the 128-bit key of its vector, and one node per valid vector."""
    valid = (F.col("embedding").isNotNull() & (F.size("embedding") > 0)
             & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
             & F.exists("embedding", lambda x: x != 0))
    rows = vectors.select("vec_id", F.when(valid, F.col("embedding").cast("array<double>")).alias("v"))
    rows = rows.withColumn("k1", F.when(F.col("v").isNotNull(), F.xxhash64("v"))).withColumn(
        "k2", F.when(F.col("v").isNotNull(), F.xxhash64("v", F.lit(7))))
    nodes = (rows.where("v is not null").groupBy("k1", "k2")
             .agg(F.first("v").alias("v"), F.count("*").alias("n"), F.min("vec_id").alias("vec_id"))
             .withColumn("node", F.monotonically_increasing_id()))
    return rows.select("vec_id", "k1", "k2"), scratch(nodes, "hnsw-nodes")


def _unit(rows: np.ndarray) -> np.ndarray:
    top = np.abs(rows).max(axis=1, keepdims=True)          # keeps squares of huge or tiny numbers in range
    rows = rows / top
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _matrix(column, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _build(table: pa.Table) -> pa.Table:
    dim, table = table.column("dim")[0].as_py(), table.sort_by("node")
    x = _unit(_matrix(table.column("v"), dim))
    shard = {"graph": Graph(x), "x": x, "node": table.column("node").to_numpy(), "n": table.column("n").to_numpy()}
    return pa.table({"dim": pa.array([dim], pa.int32()), "shard": table.column("shard").slice(0, 1), "index": pa.array([pickle.dumps(shard, 5)], pa.binary())})


def _links(shard: dict, q: np.ndarray, threshold: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(query number, node number in the shard) of all links found, verified in double precision, and the
    queries answered by exact products there (none for links of a search)."""
    graph, x = shard["graph"], shard["x"]
    low, todo = threshold - _SLACK, np.arange(len(q))
    q32 = q.astype(np.float32)
    while len(todo):
        if beam > MOST_BEAM or beam >= len(x):             # dense groups: the whole shard, block by block
            for i in range(0, len(todo), 256):
                mine = todo[i:i + 256]
                a, b = np.nonzero(q32[mine] @ graph.x.T >= low)
                yield *_verified(q, x, mine[a], b, threshold), mine
            return
        ids, sim = graph.search(q32[todo], beam)
        hit = (sim >= low) & (ids >= 0)
        full = hit.all(axis=1)
        a, b = np.nonzero(hit & ~full[:, None])
        yield *_verified(q, x, todo[a], ids[a, b], threshold), todo[:0]
        todo, beam = todo[full], beam * 4


def _verified(q, x, a, b, threshold):
    keep = np.concatenate([np.einsum("ij,ij->i", q[a[i:i + 65536]], x[b[i:i + 65536]]) >= threshold for i in range(0, len(a), 65536)] or [np.empty(0, bool)])
    return a[keep], b[keep]


def audited_beam(shard: dict, q: np.ndarray, threshold: float, own: np.ndarray | None = None, beam: int = BEAM) -> int:
    """The first beam that reaches the audit's recall against the whole shard.

    Queries that end in exact products and a query's own node (``own``: its number in the shard, or -1)
    are left out.  The others must find ``AUDIT_RECALL`` of their links, taken per query so that no
    large group outweighs the small ones, and ``AUDIT_NEAREST`` of those that have a node near the threshold
    or above their nearest one (a query whose nearest node is far below can lose no link)."""
    pick = np.unique(np.linspace(0, len(q) - 1, min(len(q), AUDIT_QUERIES)).astype(int))
    some, own = q[pick], np.full(len(pick), -1) if own is None else own[pick]
    sim = some @ shard["x"].T
    here = np.flatnonzero(own >= 0)
    sim[here, own[here]] = -3.0
    links, best = (sim >= threshold).sum(axis=1), sim.max(axis=1)
    while beam < len(shard["x"]):
        found, searched = np.zeros(len(some), int), np.ones(len(some), bool)
        for a, b, mine in _links(shard, some, threshold, beam):
            searched[mine] = False
            np.add.at(found, a[own[a] != b], 1)
        ids, near = shard["graph"].search(some.astype(np.float32), beam)
        nearest = np.where(ids == own[:, None], -3.0, near).max(axis=1) >= best - 1e-5
        judged, close = searched & (links > 0), searched & (best >= threshold - AUDIT_NEAR)
        if ((not judged.any() or (found[judged] / links[judged]).mean() >= AUDIT_RECALL)
                and (not close.any() or nearest[close].mean() >= AUDIT_NEAREST)):
            break
        beam *= 2
    return beam


def _query(threshold: float):
    """Answers of a block to a shard, rows (a, b, home, n, m); home: a shard's number.

    (a, b, -, -, -)         a link of the block's spanning forest
    (a, -, shard, n, -)     rows of ``shard`` linked with a, by exact products
    (a, -, home, -, m)      rows linked with a of the shard ``home`` that were asked by exact products
    (a, b, home of a, n, m) a link that a's search found; rows at a and at b"""
    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _rows()
        shard, asked = pickle.loads(left.column("index")[0].as_py()), left.column("shard")[0].as_py()
        right = right.sort_by([("home", "ascending"), ("node", "ascending")])
        node, q = right.column("node").to_numpy(), _unit(_matrix(right.column("v"), shard["x"].shape[1]))
        home, n = right.column("home").to_numpy(), right.column("n").to_numpy()
        at = np.minimum(np.searchsorted(shard["node"], node), len(shard["node"]) - 1)
        beam = audited_beam(shard, q, threshold, np.where(shard["node"][at] == node, at, -1))
        count, stars, out = np.zeros(len(q), np.int64), [], []
        for h in np.unique(home):                              # sorted: a home's queries follow each other
            back = np.zeros(len(shard["x"]), np.int64)
            first, last = np.searchsorted(home, [h, h + 1])
            for i in range(first, last, 1024):
                for a, b, exact in _links(shard, q[i:min(i + 1024, last)], threshold, beam):
                    other = shard["node"][b] != node[a + i]
                    a, b = a[other] + i, b[other]
                    if not len(a):
                        continue
                    stars.append(_stars(node[a], shard["node"][b]))
                    if len(exact):
                        np.add.at(count, a, shard["n"][b])
                        np.add.at(back, b, n[a])
                    else:
                        out.append(_rows(node[a], shard["node"][b], home[a], n[a], shard["n"][b]))
            hit = np.flatnonzero(back)
            out.append(_rows(shard["node"][hit], None, np.full(len(hit), h), None, back[hit]))
        hit = np.flatnonzero(count)
        out.append(_rows(node[hit], None, np.full(len(hit), asked), count[hit], None))
        if stars:
            out.append(_rows(*_stars(*(np.concatenate(p) for p in zip(*stars))), None, None, None))
        return pa.concat_tables(out)

    return run


def _rows(a=(), b=None, home=None, n=None, m=None) -> pa.Table:
    return pa.table({k: pa.nulls(len(a), t) if c is None else pa.array(c, t) for k, c, t in
                     zip(("a", "b", "home", "n", "m"), (a, b, home, n, m), (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))})


def linked(found: DataFrame) -> DataFrame:
    """(node, links): rows linked with each node, every link counted for both ends however it was found.

    Per node and shard the exact answer counts where there is one; otherwise what the shard's exactly
    answered nodes found, and the distinct links between searched nodes that either search found."""
    alone = found.where("b is null")
    whole = alone.groupBy("a", "home").agg(F.coalesce(F.sum("n"), F.sum("m")).alias("links")).select(F.col("a").alias("node"), "links")
    exact = alone.where("n is not null").select("a", "home")
    pairs = (found.where("b is not null and home is not null")
             .select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"), "a", "b", "home",
                     F.when(F.col("a") < F.col("b"), F.col("n")).otherwise(F.col("m")).alias("nx"),
                     F.when(F.col("a") < F.col("b"), F.col("m")).otherwise(F.col("n")).alias("ny"))
             .groupBy("x", "y").agg(F.count("*").alias("ways"), F.first("nx").alias("nx"), F.first("ny").alias("ny"),
                                    F.first("b").alias("b"), F.first("home").alias("home")))
    # a link only one end's search found: the other end's exact answer, if it gave one, has it already
    one = pairs.where("ways = 1").join(exact.select(F.col("a").alias("b"), "home"), ["b", "home"], "left_anti")
    both = pairs.where("ways > 1").unionByName(one.select(*pairs.columns))
    ends = both.select(F.explode(F.array(F.struct(F.col("x").alias("node"), F.col("ny").alias("links")),
                                         F.struct(F.col("y").alias("node"), F.col("nx").alias("links")))).alias("e")).select("e.*")
    return whole.unionByName(ends).groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, shards: int = SHARDS) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding)."""
    rows, nodes = nodes_of(vectors)
    n = nodes.count()
    n_shards, n_blocks = max(shards, -(-n // SHARD_ROWS)), max(BLOCKS, -(-n // BLOCK_ROWS))
    dealt = nodes.select("node", "n", "v", F.size("v").alias("dim"),
                         F.pmod(F.xxhash64("node"), F.lit(n_shards)).cast("int").alias("shard"),
                         F.pmod(F.xxhash64("node", F.lit(3)), F.lit(n_blocks)).cast("int").alias("block"))
    index = scratch(dealt.groupBy("dim", "shard").applyInArrow(_build, "dim int, shard int, index binary"), "hnsw-index")
    units = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    asked = (dealt.select("dim", "block", "node", "n", "v", F.col("shard").alias("home"))
             .withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1)))))
    keys = ["dim", "shard", "block"]
    found = scratch(units.groupBy(*keys).cogroup(asked.groupBy(*keys))
                    .applyInArrow(_query(threshold), "a long, b long, home int, n long, m long"), "hnsw-links")
    counts = linked(found)
    roots = components(found.where("b is not null and home is null").select("a", "b")).select(F.col("id").alias("node"), "root")
    known = (nodes.select("node", "k1", "k2", "n", "vec_id").join(counts, "node", "left").join(roots, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    least = known.groupBy("root").agg(F.min("vec_id").alias("component_id"))
    known = known.join(least, "root").select("k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), "component_id")
    # Vectors that link with nothing have no key and join nothing; they stay their own component.
    out = rows.join(known, ["k1", "k2"], "left")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      F.when(F.col("k1").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
                      F.coalesce(F.when(F.col("k1").isNull(), F.lit(True)).otherwise(F.col("vec_id") == F.col("component_id")), F.lit(False)).alias("kept"))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e,
         embedding IS NOT NULL AND len(embedding) > 0
         AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok
  FROM embeddings),
l AS (SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.ok AND b.ok AND a.r <> b.r AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(a, b) AS (SELECT r, r FROM v UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a),
c AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON reach.b = v.r GROUP BY reach.a),
k AS (SELECT a AS r, count(*) AS n FROM l GROUP BY a)
SELECT v.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN c USING (r) LEFT JOIN k USING (r)
"""
