import numpy as np
import pytest

from tidemark.llm import embeddings as em
from tidemark.llm.hnsw import Graph

SF = "/root/testdata/sf0.01"


def brute(rows, threshold=0.9):
    """Expected (vec_id, n_links, component_id, kept) and the link matrix, all rows against all."""
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v) for _, v in rows]
    link = np.zeros((len(rows), len(rows)), bool)
    for d in {len(v) for (_, v), k in zip(rows, ok) if k}:
        at = [i for i, ((_, v), k) in enumerate(zip(rows, ok)) if k and len(v) == d]
        x = np.array([rows[i][1] for i in at], float)
        x /= np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        link[np.ix_(at, at)] = x @ x.T >= threshold
    np.fill_diagonal(link, False)
    comp = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            m = min([comp[j] for j in np.flatnonzero(link[i])] + [comp[i]])
            if m < comp[i]:
                comp[i], changed = m, True
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(i, int(link[k].sum()), least.get(comp[k]) if ok[k] else i, i == least.get(comp[k]) if ok[k] and i is not None else not ok[k])
            for k, (i, _) in enumerate(rows)]


def got(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted((tuple(r) for r in em.near_duplicates(df, **kw).collect()), key=str)


def f32(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


def test_edges_against_all_pairs(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (9, [1.0, 0.0]), (8, [2.0, 0.0]),
            (7, [1.0, 0.1]), (7, [1.0, 0.1]), (11, [0.0, 1.0]), (12, [0.0, 1.0, 0.0]), (13, [0.0, 1.0, 0.01]), (None, [0.0, 3.0]),
            (14, [-1.0, 0.0]), (15, [1e-30, 1e-31]), (16, [-1e30, 1e29])]
    rows = [(i, f32(v)) for i, v in rows]
    assert got(spark, rows) == sorted(brute(rows), key=str)
    assert got(spark, []) == []


def test_whole_small_table_reaches_recall(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want, have = sorted(brute(rows), key=str), got(spark, rows)
    assert [r[0] for r in want] == [r[0] for r in have]
    assert sum(r[1] for r in have) >= 0.99 * sum(r[1] for r in want)
    assert all(h[1] <= w[1] for h, w in zip(have, want))
    assert np.mean([h == w for h, w in zip(have, want)]) >= 0.99


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(120, 32))
    x = np.concatenate([centres[i % 120] + rng.normal(size=32) * 0.12 for i in range(2400)]).reshape(-1, 32)
    dense = rng.normal(size=32) + rng.normal(size=(700, 32)) * 0.02
    x = np.concatenate([x, dense, rng.normal(size=(900, 32))])
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_graph_recall_against_exact_search(clustered):
    g = Graph(clustered)
    exact = np.argsort(-(clustered[::9] @ clustered.T), axis=1)[:, :10]
    ids, sim = g.search(clustered[::9].astype(np.float32), 64)
    tenth = np.take_along_axis(clustered[::9] @ clustered.T, exact[:, 9:], 1)
    assert (sim[:, :10] >= tenth - 1e-5).mean() >= 0.95
    assert ids.shape[1] == 64 and (np.sort(ids, axis=1)[:, 1:] != np.sort(ids, axis=1)[:, :-1]).all()


def test_dense_groups_are_not_cut_off(spark, clustered, monkeypatch):
    rows = [(i, f32(v)) for i, v in enumerate(clustered)]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    have = {r[0]: r for r in got(spark, rows)}
    assert sum(have[i][1] for i in have) >= 0.99 * want.sum() and all(have[i][1] <= want[i] for i in have)
    assert {have[i][2] for i in range(2400, 3100)} == {2400} and have[2500][1] == 699


class HalfBlind:
    """A graph that finds a query's pair only with a beam of 64 or more; all else it finds."""

    def __init__(self, x, pairs):
        self.x, self.pairs = x.astype(np.float32), pairs

    def search(self, q, beam):
        sim = q @ self.x.T
        if beam < 64:
            sim[:, self.pairs:] = np.where(sim[:, self.pairs:] > 0.9999, sim[:, self.pairs:], -2.0)
        order = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
        return order.astype(np.int32), np.take_along_axis(sim, order, 1)


def test_audit_sees_pairs_beside_a_dense_group():
    rng = np.random.default_rng(3)
    dense = rng.normal(size=64) + rng.normal(size=(600, 64)) * 0.02
    pairs = np.repeat(rng.normal(size=(300, 64)), 2, axis=0) + rng.normal(size=(600, 64)) * 0.1
    x = np.concatenate([dense, pairs])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    shard = {"graph": HalfBlind(x, 600), "x": x}
    assert em.audited_beam(shard, x, 0.9, np.arange(len(x))) >= 64
    assert em.audited_beam(shard, x[:600], 0.9, np.arange(600)) == em.BEAM      # a dense group is answered exactly


def test_small_groups_reach_recall_apart_from_the_dense_one(spark):
    rng = np.random.default_rng(5)
    dense = rng.normal(size=32) + rng.normal(size=(1500, 32)) * 0.02
    pairs = np.repeat(rng.normal(size=(1500, 32)), 2, axis=0) + rng.normal(size=(3000, 32)) * 0.12
    rows = [(i, f32(v)) for i, v in enumerate(np.concatenate([dense, pairs]))]
    x = np.array([v for _, v in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.9).sum(axis=1) - 1
    have = {r[0]: r for r in got(spark, rows, shards=2)}
    small = [i for i in range(1500, 4500) if want[i]]
    assert np.mean([have[i][1] == want[i] for i in small]) >= 0.99
    assert all(have[i][1] == 1499 for i in range(1500))


def test_links_found_from_one_end_count_for_both(spark, monkeypatch):
    """Searches that miss every node numbered lower than the query's own in the shard's order by first number."""
    rng = np.random.default_rng(11)
    dense = rng.normal(size=16) + rng.normal(size=(700, 16)) * 0.1
    pairs = np.repeat(rng.normal(size=(300, 16)), 2, axis=0) + rng.normal(size=(600, 16)) * 0.05
    rows = [(i, f32(v)) for i, v in enumerate(np.concatenate([dense, dense[:40], pairs, pairs[:50]]))]

    def half(self, q, beam):
        sim = q @ self.x.T
        sim[q[:, :1] > self.x[None, :, 0] + 1e-7] = -2.0
        order = np.argsort(-sim, axis=1, kind="stable")[:, :beam]
        return order.astype(np.int32), np.take_along_axis(sim, order, 1)

    monkeypatch.setattr(Graph, "search", half)
    monkeypatch.setattr(em, "audited_beam", lambda *_: em.BEAM)
    spark_rows = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    _, nodes = em.nodes_of(spark_rows)
    nodes = nodes.toPandas()
    x = np.stack(nodes["v"])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    node, n = nodes["node"].to_numpy(), nodes["n"].to_numpy()
    home = node % 3
    import pickle

    import pyarrow as pa
    order = np.argsort(node)
    x, node, n, home = x[order], node[order], n[order], home[order]
    parts = []
    for s in range(3):
        k = np.flatnonzero(home == s)
        shard = {"graph": Graph(x[k]), "x": x[k], "node": node[k], "n": n[k]}
        left = pa.table({"shard": pa.array([s], pa.int32()), "index": pa.array([pickle.dumps(shard, 5)], pa.binary())})
        for c in range(2):
            q = np.flatnonzero(node // 3 % 2 == c)
            right = pa.table({"node": node[q], "n": n[q], "home": pa.array(home[q], pa.int32()), "v": pa.array(list(x[q]), pa.list_(pa.float64()))})
            parts.append(em._query(0.9)((), left, right).to_pandas().astype(object).where(lambda d: d.notna(), None))
    found = spark.createDataFrame([tuple(None if v is None else int(v) for v in r) for p in parts for r in p.itertuples(index=False)],
                                  "a long, b long, home int, n long, m long")
    have = {r["node"]: r["links"] for r in em.linked(found).collect()}
    link = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    want = link @ n
    assert found.where("n is not null and b is null").count() and found.where("b is not null and home is not null").count()
    assert [have.get(v, 0) for v in node.tolist()] == want.tolist()


def test_work_per_search_is_flat_in_shard_size(monkeypatch):
    """Nodes compared per query, at 2,000 and 16,000 nodes."""
    from tidemark.llm import hnsw
    seen = []
    real = hnsw._only_new

    def counted(held, new):
        out = real(held, new)
        seen.append(int((out >= 0).sum()))
        return out

    rng, per = np.random.default_rng(2), {}
    for n in (2000, 16000):
        x = rng.normal(size=(n, 32))
        graph = hnsw.Graph(x / np.linalg.norm(x, axis=1, keepdims=True))
        monkeypatch.setattr(hnsw, "_only_new", counted)
        seen.clear()
        q = graph.x[:500] + 0.02 * rng.normal(size=(500, 32)).astype(np.float32)
        ids, _ = graph.search(q / np.linalg.norm(q, axis=1, keepdims=True), 32)
        monkeypatch.setattr(hnsw, "_only_new", real)
        per[n] = sum(seen) / 500
        assert (ids[:, 0] == np.arange(500)).mean() >= 0.99
    assert per[16000] < 1.5 * per[2000]
