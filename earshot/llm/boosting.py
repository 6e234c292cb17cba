"""Gradient boosting of shallow trees for two classes, in NumPy: Newton steps on binned features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass(frozen=True)
class Boosted:
    """Complete trees of one depth: per tree the feature and the bound of every inner node, and the leaves."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    bound: np.ndarray
    leaf: np.ndarray  # trees x leaves

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log odds of every row."""
        out = np.full(len(x), self.start)
        every = np.arange(len(x))
        for feature, bound, leaf in zip(self.feature, self.bound, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < len(feature):
                node = 2 * node + 1 + (x[every, feature[node]] > bound[node])
            out += leaf[node - len(feature)]
        return out


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def log_loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, np.where(y, -z, z))))


def _cuts(column: np.ndarray) -> np.ndarray:
    """Bounds between bins, of about equal rows."""
    values = np.unique(column)
    if len(values) > BINS:
        values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
    return (values[:-1] + values[1:]) / 2


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3, ridge: float = 1.0) -> Boosted:
    """Trees that lower the log loss of ``y`` (booleans); ties go to the first feature and the lowest bound."""
    cuts = [_cuts(c) for c in x.T]
    binned = np.stack([np.searchsorted(c, col) for c, col in zip(cuts, x.T)]).astype(np.int64)
    bounds = np.full((x.shape[1], BINS), np.inf)
    for f, c in enumerate(cuts):
        bounds[f, : len(c)] = c
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    z = np.full(len(y), start)
    inner, leaves = (1 << depth) - 1, 1 << depth
    grown = []
    for _ in range(rounds):
        p = sigmoid(z)
        slope, curve = y - p, p * (1 - p)
        node = np.zeros(len(y), np.int64)  # within the level
        feature, bound = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            nodes = 1 << level
            gains = np.empty((x.shape[1], nodes, BINS))
            for f, bins in enumerate(binned):
                at = node * BINS + bins
                g, h = (np.bincount(at, w, nodes * BINS).reshape(nodes, BINS) for w in (slope, curve))
                left_g, left_h = g.cumsum(1), h.cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gains[f] = left_g**2 / (left_h + ridge) + (all_g - left_g) ** 2 / (all_h - left_h + ridge) - all_g**2 / (all_h + ridge)
            gains[~np.isfinite(bounds)[:, None, :].repeat(nodes, 1)] = 0
            flat = gains.transpose(1, 0, 2).reshape(nodes, -1)
            best = flat.argmax(1)
            f, b = np.divmod(best, BINS)
            useful = flat[np.arange(nodes), best] > 1e-9
            feature[nodes - 1 : 2 * nodes - 1] = np.where(useful, f, 0)
            bound[nodes - 1 : 2 * nodes - 1] = np.where(useful, bounds[f, b], np.inf)
            own = nodes - 1 + node
            node = 2 * node + (x[np.arange(len(y)), feature[own]] > bound[own])
        leaf = rate * np.bincount(node, slope, leaves) / (np.bincount(node, curve, leaves) + ridge)
        z += leaf[node]
        grown.append((feature, bound, leaf))
    return Boosted(start, *(np.stack(part) for part in zip(*grown)))
