"""Gradient-boosted trees and isotonic calibration, fitted on a bounded sample that fits on the driver."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Boosted:
    """Logistic boosting of complete trees of one depth over binned features."""

    depth: int = 3
    rounds: int = 60
    rate: float = 0.15
    bins: int = 32
    l2: float = 1.0
    least: float = 8.0
    base: float = 0.0
    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        """x: rows by features, y: 0 or 1. Without both classes the score is the smoothed base rate."""
        n, k = x.shape
        p = (y.sum() + 0.5) / (n + 1)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        if n == 0 or y.min() == y.max():
            return self
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1], method="lower")) for j in range(k)]
        binned = np.stack([np.searchsorted(cuts[j], x[:, j], side="left") for j in range(k)], axis=1)
        margin = np.full(n, self.base)
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-margin))
            tree, leaf = self._tree(binned, cuts, y - q, q * (1 - q))
            self.trees.append(tree)
            margin += tree[2][leaf]
        return self

    def _tree(self, binned, cuts, g, h):
        n, k = binned.shape
        inner = (1 << self.depth) - 1
        feature, cut = np.zeros(inner, dtype=int), np.full(inner, np.inf)
        node = np.zeros(n, dtype=int)
        for level in range(self.depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.full(width, 1e-9)
            place = [(0, -1)] * width
            for j in range(k):
                m = len(cuts[j]) + 1
                at = node * m + binned[:, j]
                gs = np.bincount(at, g, width * m).reshape(width, m)
                hs = np.bincount(at, h, width * m).reshape(width, m)
                gl, hl = gs.cumsum(1)[:, :-1], hs.cumsum(1)[:, :-1]
                ga, ha = gs.sum(1, keepdims=True), hs.sum(1, keepdims=True)
                gain = gl**2 / (hl + self.l2) + (ga - gl) ** 2 / (ha - hl + self.l2) - ga**2 / (ha + self.l2)
                few = self.least / 4
                gain = np.where((hl < few / 4) | (ha - hl < few / 4), 0, gain)
                for w in range(width):
                    if m > 1 and gain[w].max() > best[w]:
                        best[w], place[w] = gain[w].max(), (j, int(gain[w].argmax()))
            for w, (j, b) in enumerate(place):
                if b >= 0:
                    feature[first + w], cut[first + w] = j, cuts[j][b]
            bin_cut = np.array([b if b >= 0 else 1 << 30 for _, b in place])
            of = np.array([j for j, _ in place])
            node = node * 2 + (binned[np.arange(n), of[node]] > bin_cut[node])
        leaves = 1 << self.depth
        value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.l2)
        return (feature, cut, value), node

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, value in self.trees:
            node = np.zeros(len(x), dtype=int)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += value[node - len(feature)]
        return out

    def column(self, features: list[Column]) -> Column:
        """The margin as a Spark expression over feature columns."""
        total = F.lit(self.base)
        for feature, cut, value in self.trees:

            def branch(node: int, feature=feature, cut=cut, value=value) -> Column:
                if node >= len(feature):
                    return F.lit(float(value[node - len(feature)]))
                if np.isinf(cut[node]):
                    return branch(2 * node + 1)
                return F.when(features[feature[node]] > F.lit(float(cut[node])), branch(2 * node + 2)).otherwise(branch(2 * node + 1))

            total = total + branch(0)
        return total


@dataclass
class Isotonic:
    """A rising map of margins to probabilities: pooled adjacent violators, straight lines between blocks."""

    x: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    y: np.ndarray = field(default_factory=lambda: np.array([0.0]))

    def fit(self, margin: np.ndarray, label: np.ndarray) -> Isotonic:
        """Without rows, the map is the logistic function at a few points."""
        if not len(margin):
            self.x = np.linspace(-8, 8, 33)
            self.y = 1 / (1 + np.exp(-self.x))
            return self
        order = np.argsort(margin, kind="stable")
        blocks: list[list[float]] = []  # sum of margins, sum of labels, rows
        for m, v in zip(margin[order].tolist(), label[order].tolist(), strict=True):
            blocks.append([m, v, 1.0])
            while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
        self.x = np.array([b[0] / b[2] for b in blocks])
        self.y = np.array([(b[1] + 0.02) / (b[2] + 0.04) for b in blocks])
        self.y = np.maximum.accumulate(self.y)
        return self

    def __call__(self, margin: np.ndarray) -> np.ndarray:
        return np.interp(margin, self.x, self.y)
