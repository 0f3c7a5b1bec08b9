"""Small gradient-boosted trees and isotonic calibration in numpy, for bounded samples."""

from __future__ import annotations

import numpy as np

BINS = 32


class Trees:
    """Boosted complete trees for the logistic loss; each level of a tree splits every node it has."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.15, least: float = 1.0):
        self.rounds, self.depth, self.rate, self.least = rounds, depth, rate, least
        self.base, self.features, self.cuts, self.leaves = 0.0, [], [], []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        share = (y.sum() + 0.5) / (len(y) + 1)
        self.base = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
        coded = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        margin = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-margin))
            grad, hess = p - y, np.maximum(p * (1 - p), 1e-6)
            node = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                first, many = 2**level - 1, 2**level
                best = np.full(many, 1e-9)
                chosen = [(0, None)] * many
                for f, e in enumerate(edges):
                    if not len(e):
                        continue
                    at = node * (BINS + 1) + coded[:, f]
                    g = np.bincount(at, grad, many * (BINS + 1)).reshape(many, -1).cumsum(axis=1)
                    h = np.bincount(at, hess, many * (BINS + 1)).reshape(many, -1).cumsum(axis=1)
                    gl, hl, gt, ht = g[:, : len(e)], h[:, : len(e)], g[:, -1:], h[:, -1:]
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    gain[(hl < self.least) | (ht - hl < self.least)] = 0
                    b = gain.argmax(axis=1)
                    for k in range(many):
                        if gain[k, b[k]] > best[k]:
                            best[k], chosen[k] = gain[k, b[k]], (f, int(b[k]))
                right = np.zeros(len(y), np.int64)
                for k, (f, b) in enumerate(chosen):
                    if b is not None:
                        feature[first + k], cut[first + k] = f, edges[f][b]
                        right += (node == k) & (coded[:, f] > b)
                node = 2 * node + right
            g, h = np.bincount(node, grad, 2**self.depth), np.bincount(node, hess, 2**self.depth)
            leaf = -self.rate * g / (h + 1)
            margin += leaf[node]
            self.features.append(feature)
            self.cuts.append(cut)
            self.leaves.append(leaf)
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        margin, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.features, self.cuts, self.leaves, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > cut[at])
            margin += leaf[at - (2**self.depth - 1)]
        return 1 / (1 + np.exp(-margin))


def isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: (scores, calibrated values), both ascending, to interpolate between.

    Each pool is shrunk by half a case of either kind, so that no pool claims certainty.
    """
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum of y, weight, lowest score, highest score
    for s, t in zip(score[order].tolist(), y[order].tolist(), strict=True):
        pools.append([t, 1.0, s, s])
        while len(pools) > 1 and (pools[-2][3] == pools[-1][2] or pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]):
            t2, w2, _, high = pools.pop()
            pools[-1][0] += t2
            pools[-1][1] += w2
            pools[-1][3] = high
    xs, ys = [], []
    for t, w, low, high in pools:
        value = (t + 0.5) / (w + 1)
        xs += [low, high]
        ys += [value, value]
    return np.array(xs), np.maximum.accumulate(np.array(ys))
