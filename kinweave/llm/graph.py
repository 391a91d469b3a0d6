"""A directed neighbour graph over unit vectors, in numpy.

Vectors are inserted in growing batches. Each is looked up by a greedy beam search
in the graph so far; what the search finds and the vectors of its own batch are
candidates for its edges, and robust pruning keeps the nearest candidate, drops
all that are nearer to it than relaxed by alpha to the vector, and goes on with
what is left. Edges are added both ways and pruned again where a node has too
many. All steps run on whole batches.
"""

from __future__ import annotations

import numpy as np

F32 = np.float32


def _key(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k highest scores of each row, best first."""
    if scores.shape[1] > k:
        part = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    else:
        part = np.broadcast_to(np.arange(scores.shape[1]), scores.shape)
    order = np.argsort(-np.take_along_axis(scores, part, 1), axis=1, kind="stable")
    return np.take_along_axis(part, order, 1)


def robust_prune(x: np.ndarray, nodes: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """(nodes, degree) edges chosen from cand (nodes, c), -1 where there are fewer. Distances are 1 - cosine.

    A candidate listed twice falls with its first mention, at distance 0 from it.
    """
    n, c = cand.shape
    vec = x[np.maximum(cand, 0)]
    far = 1 - np.matmul(vec, x[nodes][:, :, None])[:, :, 0]
    near = np.matmul(vec, vec.transpose(0, 2, 1))  # candidate to candidate
    np.subtract(1, near, out=near)
    near *= alpha
    far[(cand < 0) | (cand == nodes[:, None])] = np.inf
    left = far.copy()
    out = np.full((n, degree), -1, np.int32)
    rows = np.arange(n)
    for k in range(degree):
        first = left.argmin(axis=1)
        some = np.isfinite(left[rows, first])
        if not some.any():
            break
        out[some, k] = cand[rows[some], first[some]]
        left[near[rows, first] <= far] = np.inf
        left[rows, first] = np.inf
    return out


class Graph:
    """Nodes keep up to slots edges; one that would get more is pruned to degree."""

    def __init__(self, x: np.ndarray, degree: int = 14, slots: int = 24, beam: int = 16, alpha: float = 1.2, seed: int = 0):
        self.x, self.degree, self.slots = np.ascontiguousarray(x, F32), degree, slots
        n = len(x)
        self.edges = np.full((n, slots), -1, np.int32)
        self.fill = np.zeros(n, np.int32)
        order = np.random.default_rng(seed).permutation(n).astype(np.int32)
        marks = min(n, max(16, int(2 * np.sqrt(n))))
        self.marks = order[:marks]
        done = min(n, max(marks, 2 * degree))
        self._insert(order[:done], None, alpha)
        while done < n:
            size = min(n - done, 2048, done)
            batch = order[done : done + size]
            found, _ = self.search(self.x[batch], beam, beam)
            self._insert(batch, found, alpha)
            done += size

    def _insert(self, batch: np.ndarray, found: np.ndarray | None, alpha: float) -> None:
        for lo in range(0, len(batch), 512):
            part = batch[lo : lo + 512]
            own = self.x[part] @ self.x[batch].T
            own[np.arange(len(part)), lo + np.arange(len(part))] = -2
            cand = batch[_key(own, min(self.degree // 2 if found is not None else 2 * self.degree, len(batch)))]
            if found is not None:
                cand = np.concatenate([found[lo : lo + 512], cand], axis=1)
            chosen = robust_prune(self.x, part, cand, self.degree, alpha)
            self.edges[part, : self.degree] = chosen
            self.fill[part] = (chosen >= 0).sum(axis=1)
        a = np.repeat(batch, self.degree)
        b = self.edges[batch, : self.degree].ravel()
        a, b = a[b >= 0], b[b >= 0]
        if not len(b):
            return
        # back edges: the nearest come first, and at most slots of them are offered to a node at a time
        order = np.lexsort((-np.einsum("ij,ij->i", self.x[a], self.x[b]), b))
        a, b = a[order], b[order]
        first = np.concatenate([[True], b[1:] != b[:-1]])
        head, row = np.flatnonzero(first), np.cumsum(first) - 1
        place = np.arange(len(b)) - head[row]
        nodes = b[head]
        more = np.bincount(row, minlength=len(nodes))
        room = self.fill[nodes] + more <= self.slots
        fits = room[row]
        self.edges[b[fits], self.fill[b[fits]] + place[fits]] = a[fits]
        self.fill[nodes[room]] += more[room]
        full = np.flatnonzero(~room)
        if not len(full):
            return
        number = np.full(len(nodes), -1)
        number[full] = np.arange(len(full))
        offered = np.full((len(full), self.slots), -1, np.int32)
        take = ~fits & (place < self.slots)
        offered[number[row[take]], place[take]] = a[take]
        for lo in range(0, len(full), 512):
            q = nodes[full[lo : lo + 512]]
            wide = int(min(self.slots, more[full[lo : lo + 512]].max()))
            chosen = robust_prune(self.x, q, np.concatenate([self.edges[q], offered[lo : lo + 512, :wide]], axis=1), self.degree, alpha)
            self.edges[q] = -1
            self.edges[q, : self.degree] = chosen
            self.fill[q] = (chosen >= 0).sum(axis=1)

    def search(self, q: np.ndarray, k: int, beam: int = 16, wide: int = 4, block: int = 512) -> tuple[np.ndarray, np.ndarray]:
        """(ids, cosines) of the k nearest found for each query, best first; -1 and -2 where there are fewer."""
        ids = np.full((len(q), k), -1, np.int32)
        cos = np.full((len(q), k), -2, F32)
        for lo in range(0, len(q), block):
            i, s = self._beam(np.ascontiguousarray(q[lo : lo + block], F32), max(beam, k), wide)
            ids[lo : lo + block], cos[lo : lo + block] = i[:, :k], s[:, :k]
        return ids, cos

    def _beam(self, q: np.ndarray, beam: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(q)
        start = q @ self.x[self.marks].T
        best = _key(start, min(beam, len(self.marks)))
        ids = np.full((n, beam), -1, np.int32)
        sim = np.full((n, beam), -2, F32)
        m = best.shape[1]
        ids[:, :m], sim[:, :m] = self.marks[best], np.take_along_axis(start, best, 1)
        seen = ids < 0  # expanded, or nothing there
        seen[:, max(wide, beam // 2) :] = True  # the far half of the landmarks need not be opened
        live = np.arange(n)
        while len(live):
            todo = np.where(seen[live], F32(-3), sim[live])
            pick = np.argpartition(-todo, wide - 1, axis=1)[:, :wide] if beam > wide else np.broadcast_to(np.arange(beam), todo.shape)
            good = np.take_along_axis(todo, pick, 1) > -2
            some = good.any(axis=1)
            live, pick, good = live[some], pick[some], good[some]
            if not len(live):
                break
            at = live[:, None]
            from_ = np.where(good, ids[at, pick], 0)
            seen[at, pick] = True
            nb = self.edges[from_]
            nb = np.where(good[:, :, None], nb, -1).reshape(len(live), -1)
            # a node reached twice in this step, or already in the beam, counts once
            nb = np.sort(nb, axis=1)
            nb[:, 1:][nb[:, 1:] == nb[:, :-1]] = -1
            s = np.matmul(self.x[np.maximum(nb, 0)], q[live][:, :, None])[:, :, 0]
            worst = sim[live].min(axis=1)
            s[(nb < 0) | (s <= worst[:, None])] = -2
            rows, cols = np.nonzero(s > -2)
            if len(rows):
                again = (ids[live[rows]] == nb[rows, cols][:, None]).any(axis=1)
                s[rows[again], cols[again]] = -2
            all_s = np.concatenate([sim[live], s], axis=1)
            all_i = np.concatenate([ids[live], nb], axis=1)
            all_e = np.concatenate([seen[live], np.zeros(nb.shape, bool)], axis=1)
            top = np.argpartition(-all_s, beam - 1, axis=1)[:, :beam]
            sim[live] = np.take_along_axis(all_s, top, 1)
            ids[live] = np.take_along_axis(all_i, top, 1)
            seen[live] = np.take_along_axis(all_e, top, 1) | (sim[live] <= -2)
        order = np.argsort(-sim, axis=1, kind="stable")
        ids, sim = np.take_along_axis(ids, order, 1), np.take_along_axis(sim, order, 1)
        ids[sim <= -2] = -1
        return ids, sim
