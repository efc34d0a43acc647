"""Gradient-boosted trees for a yes-or-no label, on dense features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TREES, DEPTH, RATE, CUTS, LEAF = 60, 3, 0.2, 24, 5.0


@dataclass(frozen=True)
class Boosted:
    """Complete trees: by tree and inner node a feature and a limit, by leaf a value."""

    base: float
    features: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray

    def log_odds(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.base)
        every = np.arange(len(rows))
        for feature, limit, leaf in zip(self.features, self.limits, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (rows[every, feature[node]] > limit[node])
            total += leaf[node - (2**DEPTH - 1)]
        return total

    def probabilities(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.log_odds(rows)))


def _best_split(rows, gradient, hessian, cuts):
    """Feature and limit of the largest gain in a node; a limit of infinity if none."""
    best = (1e-6, 0, np.inf)
    total_g, total_h = gradient.sum(), hessian.sum()
    if total_h <= 0:
        return best[1:]
    whole = total_g**2 / (total_h + 1)
    for f, limits in enumerate(cuts):
        bins = np.searchsorted(limits, rows[:, f])
        g = np.cumsum(np.bincount(bins, gradient, len(limits) + 1))[:-1]
        h = np.cumsum(np.bincount(bins, hessian, len(limits) + 1))[:-1]
        gain = g**2 / (h + 1) + (total_g - g) ** 2 / (total_h - h + 1) - whole
        gain[(h < LEAF / 10) | (total_h - h < LEAF / 10)] = 0
        at = int(gain.argmax()) if len(gain) else 0
        if len(gain) and gain[at] > best[0]:
            best = (float(gain[at]), f, float(limits[at]))
    return best[1:]


def boost(rows: np.ndarray, labels: np.ndarray) -> Boosted:
    """Trees of depth ``DEPTH`` fitted to the logistic loss by Newton steps."""
    share = (labels.sum() + 1) / (len(labels) + 2)
    base = float(np.log(share / (1 - share)))
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, CUTS)))[:-1] for f in range(rows.shape[1])] if len(rows) else []
    score = np.full(len(rows), base)
    inner = 2**DEPTH - 1
    features, limits, leaves = [], [], []
    for _ in range(TREES if len(rows) else 0):
        p = 1 / (1 + np.exp(-score))
        gradient, hessian = p - labels, np.maximum(p * (1 - p), 1e-6)
        feature, limit = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(rows), np.int64)
        for depth in range(DEPTH):
            for at in range(2**depth - 1, 2 ** (depth + 1) - 1):
                here = node == at
                if here.sum() >= 2:
                    feature[at], limit[at] = _best_split(rows[here], gradient[here], hessian[here], cuts)
            node = 2 * node + 1 + (rows[np.arange(len(rows)), feature[node]] > limit[node])
        node -= inner
        g, h = np.bincount(node, gradient, inner + 1), np.bincount(node, hessian, inner + 1)
        leaf = -RATE * g / (h + 1)
        score = score + leaf[node]
        features.append(feature)
        limits.append(limit)
        leaves.append(leaf)
    empty = np.zeros((0, inner))
    return Boosted(base, np.array(features, np.int64) if features else empty.astype(np.int64), np.array(limits) if limits else empty, np.array(leaves) if leaves else np.zeros((0, inner + 1)))
