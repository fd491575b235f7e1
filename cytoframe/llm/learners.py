"""Small learners for bounded, dense samples: boosted trees, logistic regression and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def logit(p: np.ndarray, low: float = 1e-4) -> np.ndarray:
    p = np.clip(p, low, 1 - low)
    return np.log(p / (1 - p))


@dataclass
class BoostedTrees:
    """Gradient-boosted complete trees on quantile bins, for the logistic loss."""

    trees: int = 100
    depth: int = 3
    rate: float = 0.1
    bins: int = 48
    penalty: float = 1.0
    least_weight: float = 3.0
    edges: list[np.ndarray] = field(default_factory=list)
    start: float = 0.0
    features: np.ndarray | None = None
    cuts: np.ndarray | None = None
    leaves: np.ndarray | None = None

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int64)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        w = np.ones(len(y)) if weight is None else weight
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(x.shape[1])]
        b = self.binned(x)
        mean = np.clip((w * y).sum() / w.sum(), 1e-4, 1 - 1e-4)
        self.start = float(np.log(mean / (1 - mean)))
        inner, n = (1 << self.depth) - 1, x.shape[1]
        self.features = np.zeros((self.trees, inner), np.int64)
        self.cuts = np.full((self.trees, inner), self.bins + 1, np.int64)
        self.leaves = np.zeros((self.trees, inner + 1))
        raw = np.full(len(y), self.start)
        for t in range(self.trees):
            p = sigmoid(raw)
            g, h = w * (p - y), w * np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), np.int64)
            for level in range(self.depth):
                first, width = (1 << level) - 1, 1 << level
                at = node - first
                best = np.full(width, 1e-9)
                for j in range(n):
                    index = at * (self.bins + 1) + b[:, j]
                    gs = np.bincount(index, g, width * (self.bins + 1)).reshape(width, -1).cumsum(axis=1)
                    hs = np.bincount(index, h, width * (self.bins + 1)).reshape(width, -1).cumsum(axis=1)
                    gt, ht = gs[:, -1:], hs[:, -1:]
                    gain = gs**2 / (hs + self.penalty) + (gt - gs) ** 2 / (ht - hs + self.penalty) - gt**2 / (ht + self.penalty)
                    gain[(hs < self.least_weight * 0.1) | (ht - hs < self.least_weight * 0.1)] = -1
                    cut = gain.argmax(axis=1)
                    top = gain[np.arange(width), cut]
                    better = top > best
                    best[better] = top[better]
                    self.features[t, first : first + width][better] = j
                    self.cuts[t, first : first + width][better] = cut[better]
                node = 2 * node + 1 + (b[np.arange(len(y)), self.features[t, node]] > self.cuts[t, node])
            leaf = node - inner
            self.leaves[t] = -self.rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + self.penalty)
            raw += self.leaves[t, leaf]
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.binned(x), np.arange(len(x))
        out = np.full(len(x), self.start)
        inner = (1 << self.depth) - 1
        for t in range(self.trees):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (b[rows, self.features[t, node]] > self.cuts[t, node])
            out += self.leaves[t, node - inner]
        return out


@dataclass
class Logistic:
    """Ridge-penalised logistic regression by Newton's method on standardised columns."""

    penalty: float = 1.0
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    weights: np.ndarray | None = None

    def _columns(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([np.ones((len(x), 1)), (x - self.mean) / self.scale])

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> Logistic:
        w = np.ones(len(y)) if weight is None else weight
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-6
        c = self._columns(x)
        self.weights = np.zeros(c.shape[1])
        ridge = np.full(c.shape[1], self.penalty)
        ridge[0] = 1e-6
        for _ in range(15):
            p = sigmoid(c @ self.weights)
            h = (c * (w * np.maximum(p * (1 - p), 1e-5))[:, None]).T @ c + np.diag(ridge)
            step = np.linalg.solve(h, c.T @ (w * (y - p)) - ridge * self.weights)
            self.weights += step
            if np.abs(step).max() < 1e-6:
                break
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._columns(x) @ self.weights


@dataclass
class Isotonic:
    """Pool-adjacent-violators calibration with a small prior, linear between the pools."""

    at: np.ndarray | None = None
    value: np.ndarray | None = None

    def fit(self, raw: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(raw, kind="stable")
        pools: list[list[float]] = []  # sum of labels, rows, sum of scores
        for r, label in zip(raw[order], y[order], strict=True):
            pools.append([float(label), 1.0, float(r)])
            while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        prior = float(np.mean(y)) if len(y) else 0.5
        self.at = np.array([p[2] / p[1] for p in pools])
        value = np.array([(p[0] + prior) / (p[1] + 1) for p in pools])
        self.value = np.maximum.accumulate(value)
        return self

    def __call__(self, raw: np.ndarray) -> np.ndarray:
        return np.interp(raw, self.at, self.value)
