"""Gradient-boosted trees for two classes, on binned features, in numpy. Deterministic."""

from __future__ import annotations

import numpy as np


class Boosted:
    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.3, bins: int = 24, least: float = 4.0):
        self.rounds, self.depth, self.rate, self.bins, self.least = rounds, depth, rate, bins, least

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        x, y = np.asarray(x, float), np.asarray(y, float)
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        binned = self._bin(x)
        share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        f = np.full(len(y), self.start)
        self.trees = []
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-f))
            tree = self._grow(binned, y - p, p * (1 - p))
            self.trees.append(tree)
            f += self._run(tree, binned)
        return self

    def _bin(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1)

    def _grow(self, binned: np.ndarray, g: np.ndarray, h: np.ndarray) -> list:
        """Nodes as (feature, bin, left, right, value); a leaf has feature -1."""
        nodes: list = []

        def node(rows: np.ndarray, depth: int) -> int:
            at = len(nodes)
            sg, sh = g[rows].sum(), h[rows].sum()
            nodes.append((-1, 0, 0, 0, self.rate * sg / (sh + 1.0)))
            if depth == self.depth or sh < 2 * self.least / 4:
                return at
            best, base = (1e-6, -1, 0), sg * sg / (sh + 1.0)
            for j in range(binned.shape[1]):
                n = len(self.edges[j]) + 1
                if n < 2:
                    continue
                cg = np.cumsum(np.bincount(binned[rows, j], g[rows], n))[:-1]
                ch = np.cumsum(np.bincount(binned[rows, j], h[rows], n))[:-1]
                gain = cg**2 / (ch + 1.0) + (sg - cg) ** 2 / (sh - ch + 1.0) - base
                gain[(ch <= 0) | (sh - ch <= 0)] = -1
                k = int(np.argmax(gain))
                if gain[k] > best[0] + 1e-12:
                    best = (float(gain[k]), j, k)
            if best[1] >= 0:
                low = binned[rows, best[1]] <= best[2]
                if low.any() and not low.all():
                    nodes[at] = (best[1], best[2], node(rows[low], depth + 1), node(rows[~low], depth + 1), 0.0)
            return at

        node(np.arange(len(g)), 0)
        return nodes

    @staticmethod
    def _run(tree: list, binned: np.ndarray) -> np.ndarray:
        feature, cut, left, right, value = (np.array(x) for x in zip(*tree, strict=True))
        at, line = np.zeros(len(binned), int), np.arange(len(binned))
        while (inner := feature[at] >= 0).any():
            to = np.where(binned[line, feature[at]] <= cut[at], left[at], right[at])
            at = np.where(inner, to, at)
        return value[at]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not len(x):
            return np.zeros(0)
        binned = self._bin(np.asarray(x, float))
        return 1 / (1 + np.exp(-(self.start + sum(self._run(t, binned) for t in self.trees))))
