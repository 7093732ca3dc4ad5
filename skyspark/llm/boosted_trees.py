"""Gradient-boosted regression trees for a binary label, in numpy."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass
class BoostedTrees:
    """Trees over quantile bins; all trees have the same depth, and a node without a gain passes everything left."""

    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    bins: int = 32
    edges: list[np.ndarray] = field(default_factory=list)
    features: np.ndarray | None = None  # tree x inner node
    cuts: np.ndarray | None = None  # tree x inner node: go right if above
    leaves: np.ndarray | None = None  # tree x leaf
    bias: float = 0.0

    def _binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k]) for k, e in enumerate(self.edges)], axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        self.edges = [np.unique(np.quantile(x[:, k], np.linspace(0, 1, self.bins + 1)[1:-1])) for k in range(x.shape[1])]
        b, n, width = self._binned(x), x.shape[1], self.bins + 1
        inner = 2**self.depth - 1
        self.features, self.cuts = np.zeros((self.trees, inner), np.int64), np.full((self.trees, inner), np.inf)
        self.leaves = np.zeros((self.trees, inner + 1))
        rate = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.bias = float(np.log(rate / (1 - rate)))
        score = np.full(len(y), self.bias)
        for t in range(self.trees):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, p * (1 - p) + 1e-6
            at = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                nodes = 2**level
                local = at - (nodes - 1)
                best = np.full(nodes, 1e-3)
                chosen = [None] * nodes
                for k in range(n):
                    key = local * width + b[:, k]
                    gs = np.bincount(key, g, nodes * width).reshape(nodes, width).cumsum(axis=1)
                    hs = np.bincount(key, h, nodes * width).reshape(nodes, width).cumsum(axis=1)
                    total_g, total_h = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + 1) + (total_g - gs) ** 2 / (total_h - hs + 1) - total_g**2 / (total_h + 1)
                    cut = gain[:, : len(self.edges[k])].argmax(axis=1) if len(self.edges[k]) else None
                    if cut is not None:
                        for node in np.flatnonzero(gain[np.arange(nodes), cut] > best):
                            best[node], chosen[node] = gain[node, cut[node]], (k, cut[node])
                go = np.zeros(len(y), bool)
                for node, split in enumerate(chosen):
                    if split is not None:
                        k, cut = split
                        self.features[t, nodes - 1 + node], self.cuts[t, nodes - 1 + node] = k, self.edges[k][cut]
                        here = local == node
                        go[here] = b[here, k] > cut
                at = 2 * at + 1 + go
            leaf = at - inner
            value = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + 1)
            self.leaves[t] = self.rate * value
            score += self.leaves[t][leaf]
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        score, rows = np.full(len(x), self.bias), np.arange(len(x))
        for features, cuts, leaves in zip(self.features, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, features[at]] > cuts[at])
            score += leaves[at - len(features)]
        return score
