"""Hierarchical navigable small-world graphs over unit vectors, in numpy.

Queries and insertions go side by side in batches: a step expands the best unexpanded nodes
of every beam at once, so the cost of a step is spread over the batch.
"""

from __future__ import annotations

import io
import math

import numpy as np

#: Links per node on upper levels (twice as many on the lowest), beam while building, queries per batch, nodes expanded per step.
LINKS, BUILD_BEAM, BATCH, EXPAND = 12, 48, 512, 4
#: Levels with at most this many nodes are searched whole.
SMALL = 64


def _select(vectors: np.ndarray, own: np.ndarray, candidates: np.ndarray, m: int) -> np.ndarray:
    """Up to m neighbours per row: nearest first, those nearer to a chosen one only if places stay free."""
    rows, k = candidates.shape
    valid = (candidates >= 0) & (candidates != own[:, None])
    near = np.einsum("bkd,bd->bk", vectors[candidates], vectors[own])
    near = np.where(valid, near, -np.inf)
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near = np.take_along_axis(candidates, order, 1), np.take_along_axis(near, order, 1)
    repeated = np.zeros_like(valid)
    by_id = np.argsort(candidates, axis=1, kind="stable")
    ids = np.take_along_axis(candidates, by_id, 1)
    np.put_along_axis(repeated, by_id[:, 1:], ids[:, 1:] == ids[:, :-1], 1)
    valid = np.isfinite(near) & ~repeated
    among = np.matmul(vectors[candidates], vectors[candidates].transpose(0, 2, 1))
    chosen = np.zeros((rows, k), dtype=bool)
    closest = np.full((rows, k), -np.inf)
    for j in range(k):
        take = valid[:, j] & (near[:, j] > closest[:, j]) & (chosen.sum(axis=1) < m)
        chosen[take, j] = True
        closest[take] = np.maximum(closest[take], among[take, j])
    rank = np.where(chosen, 0, np.where(valid, 1, 2)) * k + np.arange(k)[None, :]
    first = np.argsort(rank, axis=1, kind="stable")[:, :m]
    out = np.where(np.take_along_axis(valid, first, 1), np.take_along_axis(candidates, first, 1), -1)
    if out.shape[1] < m:
        out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
    return out.astype(np.int32)


def _connect(vectors: np.ndarray, links: np.ndarray) -> np.ndarray:
    """The links with further ones, so that every node can be reached from the first.

    Tight groups may end up with links among themselves only. Each node out of reach gets a
    link from the nearest node within reach, in a column added for it, until none is left.
    """
    n = len(links)
    reached = np.zeros(n, dtype=bool)
    frontier = np.zeros(1, dtype=np.int64)
    while n:
        while len(frontier):
            reached[frontier] = True
            ahead = np.unique(links[frontier])
            frontier = ahead[(ahead >= 0) & ~reached[ahead]]
        lost = np.flatnonzero(~reached)
        if not len(lost):
            break
        inside = np.flatnonzero(reached)
        source = np.concatenate([inside[(vectors[lost[i : i + 256]] @ vectors[inside].T).argmax(axis=1)] for i in range(0, len(lost), 256)])
        heads, first = np.unique(source, return_index=True)
        column = np.full((n, 1), -1, dtype=links.dtype)
        column[heads, 0] = lost[first]
        links = np.concatenate([links, column], axis=1)
        frontier = lost[first].astype(np.int64)
    return links


class Graph:
    """vectors: rows of length 1. levels: top first, (node numbers, links as positions in that level)."""

    def __init__(self, vectors: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray]]):
        self.vectors, self.levels = vectors, levels

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int = 7) -> "Graph":
        n = len(vectors)
        vectors = np.ascontiguousarray(vectors, dtype=np.float32)
        level = np.floor(-np.log(np.random.default_rng(seed).random(n).clip(1e-12)) / math.log(LINKS)).astype(int)
        graph = cls(vectors, [])
        top = int(level.max()) if n else 0
        while top and (level >= top).sum() < SMALL:
            top -= 1
        for l in range(top, -1, -1):
            nodes = np.flatnonzero(level >= l)
            above = graph.levels[-1][0] if graph.levels else np.zeros(0, dtype=np.int64)
            nodes = np.concatenate([above, np.setdiff1d(nodes, above)]).astype(np.int64)
            graph._add_level(nodes, LINKS if l else 2 * LINKS)
        return graph

    def _add_level(self, nodes: np.ndarray, m: int) -> None:
        vectors, n = self.vectors[nodes], len(nodes)
        links = np.full((n, m), -1, dtype=np.int32)
        done = min(n, SMALL)
        if done > 1:
            everyone = np.broadcast_to(np.arange(done), (done, done))
            links[:done] = _select(vectors, np.arange(done), np.ascontiguousarray(everyone), m)
        while done < n:
            batch = np.arange(done, min(n, done + min(done, 2 * BATCH)))
            entries = self._entries(vectors[batch], len(self.levels))
            found, _ = beam_search(vectors, links, vectors[batch], entries, BUILD_BEAM)
            within = vectors[batch] @ vectors[batch].T
            np.fill_diagonal(within, -np.inf)
            near = batch[np.argsort(-within, axis=1)[:, : min(m, len(batch) - 1)]] if len(batch) > 1 else np.zeros((1, 0), dtype=int)
            chosen = _select(vectors, batch, np.concatenate([found, near], axis=1).astype(np.int64), m)
            links[batch] = chosen
            self._link_back(vectors, links, batch, chosen, m)
            done = batch[-1] + 1
        self.levels.append((nodes, _connect(vectors, links)))

    @staticmethod
    def _link_back(vectors: np.ndarray, links: np.ndarray, batch: np.ndarray, chosen: np.ndarray, m: int) -> None:
        source, target = np.repeat(batch, chosen.shape[1]), chosen.ravel().astype(np.int64)
        source, target = source[target >= 0], target[target >= 0]
        near = np.einsum("ij,ij->i", vectors[source], vectors[target])
        order = np.lexsort((-near, target))
        source, target = source[order], target[order]
        heads, start, many = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(start, many)
        fits = place < 2 * m
        incoming = np.full((len(heads), 2 * m), -1, dtype=np.int64)
        incoming[np.repeat(np.arange(len(heads)), many)[fits], place[fits]] = source[fits]
        for i in range(0, len(heads), BATCH):
            h = heads[i : i + BATCH]
            links[h] = _select(vectors, h, np.concatenate([links[h].astype(np.int64), incoming[i : i + BATCH]], axis=1), m)

    def _entries(self, queries: np.ndarray, below: int) -> np.ndarray:
        """Positions in level `below` (its nodes begin with those of the level above) to start from."""
        entries = None
        for i, (nodes, links) in enumerate(self.levels[:below]):
            vectors = self.vectors[nodes]
            if not i:
                near = queries @ vectors.T if len(nodes) <= 16 * SMALL else None
                if near is not None:
                    entries = np.argsort(-near, axis=1)[:, :EXPAND]
                else:
                    entries, _ = beam_search(vectors, links, queries, np.zeros((len(queries), 1), dtype=np.int64), 2 * EXPAND)
            else:
                entries, _ = beam_search(vectors, links, queries, entries, 2 * EXPAND)
            entries = entries[:, :EXPAND]
        return np.zeros((len(queries), 1), dtype=np.int64) if entries is None else entries

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """(node numbers, cosines) of each query's beam, nearest first; -1 where it has fewer."""
        queries = np.ascontiguousarray(queries, dtype=np.float32)
        nodes, links = self.levels[-1]
        ids, near = [], []
        for i in range(0, len(queries), BATCH):
            part = queries[i : i + BATCH]
            entries = self._entries(part, len(self.levels) - 1)
            found, cosine = beam_search(self.lowest(), links, part, entries, beam)
            ids.append(np.where(found >= 0, nodes[found], -1))
            near.append(cosine)
        return np.concatenate(ids), np.concatenate(near)

    def lowest(self) -> np.ndarray:
        if not hasattr(self, "_lowest"):
            self._lowest = self.vectors[self.levels[-1][0]]
        return self._lowest

    def to_bytes(self) -> bytes:
        """The levels; the vectors are kept beside them."""
        out = io.BytesIO()
        np.savez(out, **{f"{k}{i}": x for i, level in enumerate(self.levels) for k, x in zip(("nodes", "links"), level)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes, vectors: np.ndarray) -> "Graph":
        with np.load(io.BytesIO(data)) as z:
            count = sum(k.startswith("nodes") for k in z.files)
            return cls(vectors, [(z[f"nodes{i}"], z[f"links{i}"]) for i in range(count)])


def beam_search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of one level; (positions, cosines) of the beam, nearest first, -1 where there are fewer."""
    rows, n = len(queries), len(vectors)
    every = np.arange(rows)[:, None]
    seen = np.zeros((rows, n + 1), dtype=bool)  # the last column takes what is missing
    ids = np.full((rows, beam), -1, dtype=np.int64)
    near = np.full((rows, beam), -np.inf, dtype=np.float32)
    open_ = np.zeros((rows, beam), dtype=bool)

    def add(live: np.ndarray, new: np.ndarray) -> None:
        new = np.sort(new, axis=1)
        fresh = new >= 0
        fresh[:, 1:] &= new[:, 1:] != new[:, :-1]
        fresh &= ~seen[live[:, None], new]
        seen[live[:, None], np.where(fresh, new, n)] = True
        cosine = np.where(fresh, np.einsum("bkd,bd->bk", vectors[new], queries[live]), -np.inf).astype(np.float32)
        all_ids = np.concatenate([ids[live], new], axis=1)
        all_near = np.concatenate([near[live], cosine], axis=1)
        all_open = np.concatenate([open_[live], fresh], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[live] = np.take_along_axis(all_near, order, 1)
        ids[live] = np.where(np.isfinite(near[live]), np.take_along_axis(all_ids, order, 1), -1)
        open_[live] = np.take_along_axis(all_open, order, 1)

    live = np.arange(rows)
    add(live, entries.astype(np.int64))
    while True:
        live = live[open_[live].any(axis=1)]
        if not len(live):
            return ids, near
        order = np.argsort(~open_[live], axis=1, kind="stable")[:, :EXPAND]  # the beam is sorted, so these are the best open ones
        is_open = np.take_along_axis(open_[live], order, 1)
        chosen = np.where(is_open, np.take_along_axis(ids[live], order, 1), -1)
        still = open_[live]
        np.put_along_axis(still, order, False, 1)
        open_[live] = still
        new = np.where((chosen >= 0)[:, :, None], links[chosen], -1).reshape(len(live), -1)
        add(live, new.astype(np.int64))
