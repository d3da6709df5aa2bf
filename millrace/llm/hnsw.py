"""A hierarchical navigable small-world graph in flat NumPy arrays, built and searched for many vectors at a time."""

from __future__ import annotations

import numpy as np


class Hnsw:
    """Over unit vectors, by inner product. ``layers[l]`` is an ``(n, degree)`` array of neighbour numbers, -1 where
    there is none; layer 0 has twice the degree of the others. Vectors are inserted in blocks: a block is linked to
    what was inserted before it and, by a block product, to its own members."""

    def __init__(self, x: np.ndarray, m: int = 12, ef_build: int = 48, seed: int = 7):
        self.x = np.ascontiguousarray(x, np.float32)
        self.m, self.ef_build = m, ef_build
        n = len(x)
        rng = np.random.default_rng(seed)
        self.level = np.minimum((-np.log(1.0 - rng.random(n)) / np.log(m)).astype(np.int64), 6)
        top = int(self.level.max()) if n else 0
        self.layers = [np.full((n, 2 * m if at == 0 else m), -1, np.int32) for at in range(top + 1)]
        self.entry, self.entry_level = (0, int(self.level[0])) if n else (-1, -1)
        self._seen = np.zeros((0, 0), bool)
        at = 1
        while at < n:  # blocks never exceed what is already in the graph
            to = min(n, at + max(1, min(at, 256)))
            self._insert(np.arange(at, to))
            at = to

    def to_bytes(self) -> dict:
        """The graph as flat arrays: the vectors, the neighbours of each layer, the degree of each layer, and the entry."""
        return {"vectors": self.x.tobytes(), "neighbours": [layer.tobytes() for layer in self.layers], "degrees": [layer.shape[1] for layer in self.layers], "entry": self.entry, "entry_level": self.entry_level}

    @classmethod
    def from_bytes(cls, dim: int, vectors: bytes, neighbours, degrees, entry: int, entry_level: int) -> Hnsw:
        """A graph to be searched, over the flat arrays as they were stored."""
        g = cls.__new__(cls)
        g.x = np.frombuffer(vectors, np.float32).reshape(-1, dim)
        g.layers = [np.frombuffer(b, np.int32).reshape(-1, int(w)) for b, w in zip(neighbours, degrees)]
        g.entry, g.entry_level, g._seen = int(entry), int(entry_level), np.zeros((0, 0), bool)
        return g

    def search(self, q: np.ndarray, k: int, ef: int = 64) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the ``k`` best found for each row of ``q``, best first; -1 fills up."""
        q = np.ascontiguousarray(q, np.float32)
        ids, sims = np.full((len(q), k), -1, np.int64), np.full((len(q), k), -np.inf, np.float32)
        if not len(self.x):
            return ids, sims
        for at in range(0, len(q), 256):
            part = q[at : at + 256]
            start = np.full((len(part), 1), self.entry, np.int64)
            for layer in range(self.entry_level, 0, -1):
                start = self._beam(part, start, layer, 2)[0]
            found, s = self._beam(part, start, 0, max(ef, k))
            w = min(k, found.shape[1])
            ids[at : at + 256, :w], sims[at : at + 256, :w] = found[:, :w], s[:, :w]
        return ids, sims

    def _beam(self, q: np.ndarray, start: np.ndarray, layer: int, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Best-first search of all rows in step; each step opens the best few unopened nodes of every row."""
        nb, x = self.layers[layer], self.x
        b, n = len(q), len(x)
        if self._seen.shape[0] < b or self._seen.shape[1] != n + 1:
            self._seen = np.zeros((max(b, 256), n + 1), bool)
        seen = self._seen[:b]
        rows = np.arange(b)
        seen[:, n] = True  # -1 leads here
        ids = start.astype(np.int64)
        sims = np.where(ids >= 0, np.einsum("bsd,bd->bs", x[ids], q), -np.inf).astype(np.float32)
        np.put_along_axis(seen, np.where(ids >= 0, ids, n), True, 1)
        opened = ids < 0
        wide = 4 if ef > 8 else 1
        live = rows
        touched = [(rows[:, None] + np.zeros_like(ids), ids)]
        if ids.shape[1] < ef:
            pad = ef - ids.shape[1]
            ids = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1)
            sims = np.pad(sims, ((0, 0), (0, pad)), constant_values=-np.inf)
            opened = np.pad(opened, ((0, 0), (0, pad)), constant_values=True)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :ef]
        ids, sims, opened = (np.take_along_axis(a, order, 1) for a in (ids, sims, opened))
        while len(live):
            free = ~opened[live]
            pick = np.argsort(opened[live], axis=1, kind="stable")[:, :wide]  # sorted by similarity already
            ok = np.take_along_axis(free, pick, 1)
            go = ok[:, 0]
            live, pick, ok = live[go], pick[go], ok[go]
            if not len(live):
                break
            node = np.where(ok, ids[live[:, None], pick], -1)
            opened[live[:, None], pick] = True
            new = np.where(node[:, :, None] >= 0, nb[node], -1).reshape(len(live), -1).astype(np.int64)
            new = np.where(seen[live[:, None], new], -1, new)
            if wide > 1:  # one node may be reached twice in a step
                o = np.argsort(new, axis=1)
                new = np.take_along_axis(new, o, 1)
                new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            r, c = np.nonzero(new >= 0)
            if not len(r):
                continue
            v = new[r, c]
            seen[live[r], v] = True
            touched.append((live[r], v))
            s = np.full(new.shape, -np.inf, np.float32)
            s[r, c] = np.einsum("ed,ed->e", x[v], q[live[r]])
            # only what beats the worst kept can enter; keep the arrays narrow
            width = int((s > sims[live, -1][:, None]).sum(1).max())
            if not width:
                continue
            if width < s.shape[1]:
                o = np.argpartition(-s, width - 1, axis=1)[:, :width]
                s, new = np.take_along_axis(s, o, 1), np.take_along_axis(new, o, 1)
            all_s = np.concatenate([sims[live], s], 1)
            order = np.argsort(-all_s, axis=1, kind="stable")[:, :ef]
            sims[live] = np.take_along_axis(all_s, order, 1)
            ids[live] = np.take_along_axis(np.concatenate([ids[live], new], 1), order, 1)
            opened[live] = np.take_along_axis(np.concatenate([opened[live], new < 0], 1), order, 1)
        for r, v in touched:
            seen[r, v] = False
        return ids, sims

    def _insert(self, block: np.ndarray) -> None:
        q = self.x[block]
        top = self.level[block]
        start = np.full((len(block), 1), self.entry, np.int64)
        near = q @ q.T
        np.fill_diagonal(near, -np.inf)
        for layer in range(max(int(self.entry_level), int(top.max())), -1, -1):
            if layer <= self.entry_level:
                found, sims = self._beam(q, start, layer, self.ef_build if (top >= layer).any() else 2)
            else:
                found, sims = np.full((len(block), 1), -1, np.int64), np.full((len(block), 1), -np.inf, np.float32)
            mine = np.nonzero(top >= layer)[0]
            if len(mine):
                inner = near[np.ix_(mine, mine)]
                w = min(self.m, len(mine))
                o = np.argpartition(-inner, w - 1, axis=1)[:, :w]
                s_in = np.take_along_axis(inner, o, 1)
                i_in = np.where(np.isfinite(s_in), block[mine][o], -1)
                cand = np.concatenate([found[mine], i_in], 1)
                cs = np.where(cand >= 0, np.concatenate([sims[mine], s_in], 1), -np.inf)
                links = self._diverse(cand, cs, self.m)
                self.layers[layer][block[mine], : self.m] = links
                self._link_back(block[mine], links, layer)
            if layer <= self.entry_level:
                keep = found[:, :2]
                start = np.where(keep >= 0, keep, found[:, :1])
        best = int(np.argmax(top))
        if top[best] > self.entry_level:
            self.entry, self.entry_level = int(block[best]), int(top[best])

    def _diverse(self, cand: np.ndarray, sims: np.ndarray, width: int) -> np.ndarray:
        """Of each row's candidates those that are nearer to the row's vector than to any kept before; filled up
        with the nearest others."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 3 * width]
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        v = self.x[np.maximum(cand, 0)]
        between = v @ v.transpose(0, 2, 1)
        b, c = cand.shape
        kept = np.zeros((b, c), bool)
        worst = np.full((b, c), -np.inf, np.float32)  # similarity to the nearest kept
        for j in range(c):
            take = (cand[:, j] >= 0) & (sims[:, j] > worst[:, j]) & (kept.sum(1) < width)
            kept[:, j] = take
            worst = np.where(take[:, None], np.maximum(worst, between[:, j]), worst)
        rank = np.where(cand < 0, 2 * c, np.where(kept, 0, c)) + np.arange(c)
        pick = np.argsort(rank, axis=1, kind="stable")[:, :width]
        out = np.take_along_axis(cand, pick, 1)
        return np.pad(out, ((0, 0), (0, width - out.shape[1])), constant_values=-1) if out.shape[1] < width else out

    def _link_back(self, src: np.ndarray, links: np.ndarray, layer: int) -> None:
        nb = self.layers[layer]
        width = nb.shape[1]
        s, d = np.repeat(src, links.shape[1]), links.ravel()
        s, d = s[d >= 0], d[d >= 0]
        if not len(d):
            return
        order = np.argsort(d, kind="stable")
        s, d = s[order], d[order]
        nodes, first, count = np.unique(d, return_index=True, return_counts=True)
        new = np.full((len(nodes), int(count.max())), -1, np.int64)
        new[np.repeat(np.arange(len(nodes)), count), np.arange(len(d)) - np.repeat(first, count)] = s
        have = (nb[nodes] >= 0).sum(1)
        fits = have + count <= width
        for j in range(new.shape[1]):  # room left: append
            ok = fits & (j < count)
            nb[nodes[ok], have[ok] + j] = new[ok, j]
        full = ~fits
        if full.any():
            at = nodes[full]
            cand = np.concatenate([nb[at].astype(np.int64), new[full]], 1)
            cand = self._once(cand)
            sims = np.where(cand >= 0, np.einsum("bcd,bd->bc", self.x[np.maximum(cand, 0)], self.x[at]), -np.inf)
            nb[at] = self._diverse(cand, sims, width)

    @staticmethod
    def _once(a: np.ndarray) -> np.ndarray:
        a = np.sort(a, axis=1)
        a[:, 1:][a[:, 1:] == a[:, :-1]] = -1
        return a
