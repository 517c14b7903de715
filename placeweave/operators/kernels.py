"""Graph and geometry kernels in numpy, for groups of bounded size."""

from __future__ import annotations

import numpy as np


class Graph:
    """An undirected weighted graph in compressed rows; self weights apart."""

    def __init__(self, n: int, l: np.ndarray, r: np.ndarray, w: np.ndarray, own: np.ndarray | None = None) -> None:
        self.n = n
        a, b, c = np.concatenate([l, r]), np.concatenate([r, l]), np.concatenate([w, w])
        order = np.lexsort((b, a))
        self.to, self.w = b[order], c[order]
        self.at = np.searchsorted(a[order], np.arange(n + 1))
        self.own = np.zeros(n) if own is None else own
        self.k = np.bincount(a, c, n) + 2 * self.own

    def near(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        return self.to[self.at[i] : self.at[i + 1]], self.w[self.at[i] : self.at[i + 1]]


def _local_moves(g: Graph, label: np.ndarray, gamma: float, m2: float, rng: np.random.Generator, within: np.ndarray | None = None) -> bool:
    """Queue of nodes; each goes to the neighbouring group with the largest gain (within: only inside its outer group)."""
    mass = np.bincount(label, g.k, g.n)
    queue, waiting = list(rng.permutation(g.n)), np.ones(g.n, bool)
    moved, head = False, 0
    while head < len(queue):
        i = queue[head]
        head += 1
        waiting[i] = False
        near, w = g.near(i)
        if within is not None:
            inside = within[near] == within[i]
            near, w = near[inside], w[inside]
        if not len(near):
            continue
        groups, inv = np.unique(label[near], return_inverse=True)
        toward = np.bincount(inv, w)
        old = label[i]
        mass[old] -= g.k[i]
        stay = float(toward[groups == old].sum()) - gamma * g.k[i] * mass[old] / m2
        gain = toward - gamma * g.k[i] * mass[groups] / m2
        best = int(gain.argmax())
        if gain[best] > stay + 1e-12 and groups[best] != old:
            label[i] = groups[best]
            moved = True
            for j in near[label[near] != label[i]]:
                if not waiting[j]:
                    waiting[j] = True
                    queue.append(j)
        mass[label[i]] += g.k[i]
    return moved


def _refined(g: Graph, outer: np.ndarray, gamma: float, m2: float, rng: np.random.Generator) -> np.ndarray:
    """Singletons merged greedily inside each group, along edges only, so that groups stay connected."""
    label = np.arange(g.n)
    mass, alone = g.k.astype(float).copy(), np.ones(g.n, bool)
    for i in rng.permutation(g.n):
        if not alone[i]:
            continue
        near, w = g.near(i)
        inside = (outer[near] == outer[i]) & (near != i)
        if not inside.any():
            continue
        groups, inv = np.unique(label[near[inside]], return_inverse=True)
        toward = np.bincount(inv, w[inside])
        gain = toward - gamma * g.k[i] * mass[groups] / m2
        best = int(gain.argmax())
        if gain[best] > 1e-12:
            mass[label[i]] -= g.k[i]
            label[i] = groups[best]
            mass[groups[best]] += g.k[i]
            alone[i] = alone[groups[best]] = False
    return label


def _merged(g: Graph, label: np.ndarray) -> tuple[Graph, np.ndarray]:
    groups, inv = np.unique(label, return_inverse=True)
    n = len(groups)
    src = np.repeat(np.arange(g.n), np.diff(g.at))
    once = src < g.to
    a, b, w = inv[src[once]], inv[g.to[once]], g.w[once]
    own = np.bincount(inv, g.own, n) + np.bincount(a[a == b], w[a == b], n)
    low, high = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
    key, at = np.unique(low * n + high, return_inverse=True)
    return Graph(n, key // n, key % n, np.bincount(at, w[a != b], len(key)) if len(key) else np.zeros(0), own), inv


def communities(n: int, l: np.ndarray, r: np.ndarray, w: np.ndarray, gamma: float = 1.0, total: float | None = None, seed: int = 42, refine: bool = True, own: np.ndarray | None = None) -> np.ndarray:
    """Group of each node: modularity with resolution gamma; refine: with the refinement that keeps groups connected.

    total: the whole graph's weight, where this is one of its components; own: weights inside the nodes.
    """
    if not len(l):
        return np.arange(n)
    g, m2 = Graph(n, l, r, w, own), 2.0 * (float(w.sum()) if total is None else total)
    rng = np.random.default_rng(seed)
    node_of = np.arange(n)  # group of the current graph that each first node is in
    label = np.arange(n)
    while True:
        _local_moves(g, label, gamma, m2, rng)
        if len(np.unique(label)) == g.n:
            break
        inner = _refined(g, label, gamma, m2, rng) if refine else label
        if len(np.unique(inner)) == g.n:
            inner = label
        smaller, inv = _merged(g, inner)
        outer = np.zeros(smaller.n, np.int64)
        outer[inv] = label
        node_of = inv[node_of]
        _, label = np.unique(outer, return_inverse=True)
        # label numbers groups of the smaller graph; they must be below its size
        g = smaller
    return label[node_of]


def modularity(n: int, l: np.ndarray, r: np.ndarray, w: np.ndarray, label: np.ndarray, gamma: float = 1.0) -> float:
    m2 = 2 * w.sum()
    k = np.bincount(l, w, n) + np.bincount(r, w, n)
    inside = 2 * w[label[l] == label[r]].sum()
    mass = np.bincount(label, k)
    return float(inside / m2 - gamma * ((mass / m2) ** 2).sum())


def pagerank(n: int, l: np.ndarray, r: np.ndarray, w: np.ndarray, damping: float = 0.85, tolerance: float = 1e-6, rounds: int = 100) -> np.ndarray:
    """Weighted, undirected; nodes without edges spread evenly. Stops at an L1 change below n * tolerance."""
    if not len(l):
        return np.full(n, 1.0 / n)
    a, b, c = np.concatenate([l, r]), np.concatenate([r, l]), np.concatenate([w, w])
    out = np.bincount(a, c, n)
    x = np.full(n, 1.0 / n)
    for _ in range(rounds):
        flow = np.bincount(b, c * x[a] / out[a], n)
        new = damping * (flow + x[out == 0].sum() / n) + (1 - damping) / n
        if np.abs(new - x).sum() < n * tolerance:
            return new
        x = new
    return x


def distances(lon: np.ndarray, lat: np.ndarray, radius: float = 6371008.8) -> np.ndarray:
    x, y = np.radians(lon), np.radians(lat)
    h = np.sin((y[:, None] - y) / 2) ** 2 + np.cos(y[:, None]) * np.cos(y) * np.sin((x[:, None] - x) / 2) ** 2
    return 2 * radius * np.arcsin(np.sqrt(np.minimum(h, 1)))


def distances_to(lon: np.ndarray, lat: np.ndarray, at_lon: float, at_lat: float, radius: float = 6371008.8) -> np.ndarray:
    x, y, u, v = np.radians(lon), np.radians(lat), np.radians(at_lon), np.radians(at_lat)
    h = np.sin((y - v) / 2) ** 2 + np.cos(y) * np.cos(v) * np.sin((x - u) / 2) ** 2
    return 2 * radius * np.arcsin(np.sqrt(np.minimum(h, 1)))


def agglomerative(d: np.ndarray, threshold: float, linkage: str = "average") -> np.ndarray:
    """Merge the two nearest clusters while they are closer than threshold; labels by first member."""
    n = len(d)
    d = d.astype(float).copy()
    np.fill_diagonal(d, np.inf)
    size, label, live = np.ones(n), np.arange(n), np.ones(n, bool)
    while live.sum() > 1:
        i, j = np.unravel_index(d.argmin(), d.shape)
        if d[i, j] >= threshold:
            break
        i, j = min(i, j), max(i, j)
        row = np.maximum(d[i], d[j]) if linkage == "complete" else (size[i] * d[i] + size[j] * d[j]) / (size[i] + size[j])
        d[i], d[:, i] = row, row
        d[i, i] = np.inf
        d[j], d[:, j] = np.inf, np.inf
        size[i] += size[j]
        live[j] = False
        label[label == j] = i
    return np.unique(label, return_inverse=True)[1]


def trimmed(lon: np.ndarray, lat: np.ndarray, most_m: float) -> np.ndarray:
    """Which points stay when the farthest from the mean goes, again and again, until all are near it."""
    stay = np.ones(len(lon), bool)
    while stay.sum() > 1:
        at = np.flatnonzero(stay)
        far = distances_to(lon[at], lat[at], lon[at].mean(), lat[at].mean(), 6371000.0)
        if far.max() <= most_m:
            break
        stay[at[far.argmax()]] = False
    return stay
