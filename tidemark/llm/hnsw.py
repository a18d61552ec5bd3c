"""A hierarchical navigable small-world graph over unit vectors, searched for many queries at once.

Layers are built from the top: a layer takes over the links of the layer above, then its own nodes are put
in by batches, each node linked to a diverse choice of the nearest ones already there (found by beam search)
and of its own batch.  Searches move a whole block of queries in lockstep, so the work is numpy calls
on blocks, not per query.  What a search costs follows from its beam and its steps: nothing is as large as
the graph, neither the blocks nor the marks of visited nodes.
"""

from __future__ import annotations

import numpy as np

LINKS = 12                 # per node in upper layers, twice that in the lowest
BUILD_BEAM = 40
BLOCK = 1024               # queries in lockstep
SMALL = 512                # so many nodes present are all compared
STEP = 3                   # nodes expanded per query and step


class Graph:
    """Vectors (float32 unit rows) and per layer the members and their neighbours."""

    def __init__(self, x: np.ndarray, seed: int = 4):
        self.x = np.ascontiguousarray(x, np.float32)
        n = len(x)
        rng = np.random.default_rng(seed)
        level = np.minimum((-np.log(rng.random(n) + 1e-12) / np.log(LINKS)).astype(int), 12)
        order = np.argsort(-level, kind="stable")
        self.layers: list[np.ndarray] = []               # neighbours by node, top layer first; -1: none
        self.entry = int(order[0]) if n else -1
        upper = 0
        for at in range(level.max() if n else -1, -1, -1):
            nodes = order[level[order] >= at]
            self._build(nodes, LINKS * (2 if at == 0 else 1), len(self.layers), upper)
            upper = len(nodes)

    def _build(self, nodes: np.ndarray, width: int, above: int, upper: int) -> None:
        near = np.full((len(self.x), width), -1, np.int32)
        if upper:
            near[:, :LINKS] = self.layers[-1]
        self.layers.append(near)
        done, size = max(upper, 1), 32
        while done < len(nodes):
            new = nodes[done:done + size]
            found = [self._nearest(self.x[new[i:i + BLOCK]], nodes[:done], above) for i in range(0, len(new), BLOCK)]
            ids, sim = (np.concatenate(p) for p in zip(*found))
            mates = self.x[new] @ self.x[new].T
            np.fill_diagonal(mates, -2.0)
            k = min(width, len(new) - 1)
            best = np.argpartition(-mates, k - 1, axis=1)[:, :k] if k > 0 else np.empty((len(new), 0), int)
            ids = np.concatenate([ids, new[best].astype(np.int32)], axis=1)
            sim = np.concatenate([sim, np.take_along_axis(mates, best, 1)], axis=1)
            near[new] = self._choose(new, ids, sim, width)
            self._back(near, new, width)
            done += len(new)
            size = min(1024, done)

    def _nearest(self, q: np.ndarray, present: np.ndarray, layer: int) -> tuple[np.ndarray, np.ndarray]:
        if len(present) <= SMALL:
            sim = q @ self.x[present].T
            return np.broadcast_to(present.astype(np.int32), sim.shape), sim
        return self._beam(q, self._down(q, layer), layer, BUILD_BEAM)

    def _choose(self, who: np.ndarray, ids: np.ndarray, sim: np.ndarray, width: int) -> np.ndarray:
        """Per row the nearest that are not nearer to one already chosen; then the nearest left."""
        sim = np.where(ids >= 0, sim, -3.0)
        order = np.argsort(-sim, axis=1, kind="stable")[:, :3 * width]
        ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
        out = np.full((len(ids), width), -1, np.int32)
        for i in range(0, len(ids), 512):
            a, s = ids[i:i + 512], sim[i:i + 512]
            v = self.x[np.maximum(a, 0)]
            mutual = np.matmul(v, v.transpose(0, 2, 1))
            taken = np.zeros(a.shape, bool)
            for k in range(a.shape[1]):
                close = (mutual[:, k] > s[:, k, None]) & taken
                taken[:, k] = (s[:, k] > -2.5) & ~close.any(axis=1) & (taken.sum(axis=1) < width)
            first = np.argsort(~taken, axis=1, kind="stable")[:, :width]
            pick = np.take_along_axis(a, first, 1)
            pick[np.take_along_axis(s, first, 1) <= -2.5] = -1
            out[i:i + len(a), :pick.shape[1]] = pick
        return out

    def _back(self, near: np.ndarray, new: np.ndarray, width: int) -> None:
        """Links back from the chosen neighbours; full lists are chosen anew."""
        to = near[new].ravel()
        frm = np.repeat(new, width).astype(np.int32)[to >= 0]
        to = to[to >= 0]
        order = np.argsort(to, kind="stable")
        to, frm = to[order], frm[order]
        who, start, count = np.unique(to, return_index=True, return_counts=True)
        sim = np.einsum("ij,ij->i", self.x[frm], self.x[to])
        most = min(int(count.max(initial=0)), 2 * width)
        # of very many links back to one node the nearest are looked at
        rank = np.lexsort((-sim, to))
        frm = frm[rank]
        place = np.arange(len(to)) - np.repeat(start, count)
        incoming = np.full((len(who), most), -1, np.int32)
        mine = place < most
        incoming[np.repeat(np.arange(len(who)), count)[mine], place[mine]] = frm[mine]
        ids = np.concatenate([near[who], incoming], axis=1)
        ids = np.where((ids[:, :, None] == ids[:, None, :]).argmax(axis=2) == np.arange(ids.shape[1]), ids, -1)
        sim = np.einsum("ijk,ik->ij", self.x[np.maximum(ids, 0)], self.x[who])
        near[who] = self._choose(who, ids, sim, width)

    def _down(self, q: np.ndarray, layer: int) -> np.ndarray:
        """The nearest node found in the layers above ``layer``, per query."""
        at = np.full(len(q), self.entry, np.int32)
        for up in range(layer):
            best = np.einsum("ij,ij->i", self.x[at], q)
            while True:
                ids = self.layers[up][at]
                sim = np.where(ids >= 0, np.einsum("ijk,ik->ij", self.x[np.maximum(ids, 0)], q), -3.0)
                k = sim.argmax(axis=1)
                top = sim[np.arange(len(q)), k]
                better = top > best
                if not better.any():
                    break
                at = np.where(better, ids[np.arange(len(q)), k], at)
                best = np.maximum(best, top)
        return at

    def _beam(self, q: np.ndarray, start: np.ndarray, layer: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of up to ``beam`` nodes per query, nearest first; -1 where fewer."""
        b, near = len(q), self.layers[layer]
        ids = np.full((b, beam), -1, np.int32)
        sim = np.full((b, beam), -3.0, np.float32)
        opened = np.zeros((b, beam), bool)               # expanded already
        ids[:, 0], sim[:, 0] = start, np.einsum("ij,ij->i", self.x[start], q)
        live = np.arange(b)
        while len(live):
            i, s, o = ids[live], sim[live], opened[live]
            open_ = np.where(o | (i < 0), -4.0, s)
            pick = np.argpartition(-open_, min(STEP, beam) - 1, axis=1)[:, :STEP]
            good = np.take_along_axis(open_, pick, 1) > -3.5
            some = good.any(axis=1)
            if not some.all():
                live, i, s, o, pick, good = live[some], i[some], s[some], o[some], pick[some], good[some]
                if not len(live):
                    break
            at = np.where(good, np.take_along_axis(i, pick, 1), -1)
            mark = np.take_along_axis(o, pick, 1) | good
            np.put_along_axis(o, pick, mark, 1)
            new = np.where(at[:, :, None] >= 0, near[np.maximum(at, 0)], -1).reshape(len(live), -1)
            new = _only_new(i, new)
            # A node seen before and out of the beam since is nearer to nothing now: it falls out again.
            r, c = np.nonzero(new >= 0)
            v = np.full(new.shape, -3.0, np.float32)
            for k in range(0, len(r), 65536):
                v[r[k:k + 65536], c[k:k + 65536]] = np.einsum("ij,ij->i", self.x[new[r[k:k + 65536], c[k:k + 65536]]], q[live[r[k:k + 65536]]])
            i, s = np.concatenate([i, new], axis=1), np.concatenate([s, v], axis=1)
            o = np.concatenate([o, np.zeros(new.shape, bool)], axis=1)
            best = np.argpartition(-s, beam - 1, axis=1)[:, :beam]
            ids[live], sim[live] = np.take_along_axis(i, best, 1), np.take_along_axis(s, best, 1)
            opened[live] = np.take_along_axis(o, best, 1)
        order = np.argsort(-sim, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)

    def search(self, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, similarities) of the nodes found for each query, nearest first."""
        n = len(self.x)
        if not n or not len(q):
            return np.full((len(q), 1), -1, np.int32), np.full((len(q), 1), -3.0, np.float32)
        if beam >= n:                                    # as wide as the shard: every node
            sim = q @ self.x.T
            order = np.argsort(-sim, axis=1, kind="stable")
            return order.astype(np.int32), np.take_along_axis(sim, order, 1)
        q = np.ascontiguousarray(q, np.float32)
        last = len(self.layers) - 1
        parts = [self._beam(p, self._down(p, last), last, beam) for p in (q[i:i + BLOCK] for i in range(0, len(q), BLOCK))]
        return tuple(np.concatenate(p) for p in zip(*parts))


def _only_new(held: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``new`` with -1 for ids that its row holds already or names before."""
    both = np.concatenate([held, new], axis=1)
    order = np.argsort(both, axis=1, kind="stable")     # of equal ids the held one comes first
    ranked = np.take_along_axis(both, order, 1)
    again = np.zeros(both.shape, bool)
    np.put_along_axis(again, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
    return np.where(again[:, held.shape[1]:], -1, new)
