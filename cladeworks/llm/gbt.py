"""Histogram gradient-boosted trees with logistic loss, flattened into arrays for vectorised traversal."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Node i of the forest: go left if x[feature[i]] <= threshold[i]; a leaf has itself as both children."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def raw(self, x: np.ndarray, block: int = 4096) -> np.ndarray:
        """Log-odds of each row: all trees and all rows of a block step down together."""
        out = np.full(len(x), self.base)
        for at in range(0, len(x) if len(self.roots) else 0, block):
            part = x[at : at + block]
            node = np.broadcast_to(self.roots, (len(part), len(self.roots)))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                node = np.where(part[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[at : at + block] += self.value[node].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def fit(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 32, least: int = 12, penalty: float = 2.0
) -> Trees:
    """Boost `rounds` trees on rows x with labels y (0 or 1); without both labels only the prior is learnt."""
    n, width = x.shape
    prior = (y.sum() + 0.5) / (n + 1.0)
    base = float(np.log(prior / (1 - prior)))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1) if n else np.zeros((0, width), int)
    # bin b holds values in (edges[b - 1], edges[b]]: going left at b means x <= edges[b]
    nodes: list[list[float]] = []
    roots, raw = [], np.full(n, base)
    for _ in range(rounds if 0 < y.sum() < n else 0):
        p = 1 / (1 + np.exp(-raw))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(_grow(nodes, binned, edges, g, h, np.arange(n), depth, bins, least, penalty, rate, raw))
    a = np.array(nodes, float).reshape(-1, 5)
    return Trees(np.array(roots, np.int64), a[:, 0].astype(np.int64), a[:, 1], a[:, 2].astype(np.int64), a[:, 3].astype(np.int64), a[:, 4], depth, base)


def _grow(nodes, binned, edges, g, h, rows, depth, bins, least, penalty, rate, raw) -> int:
    """Add the tree below these rows to nodes; its leaves' values go to raw."""
    me = len(nodes)
    nodes.append([0, np.inf, me, me, 0.0])
    total_g, total_h = g[rows].sum(), h[rows].sum()
    best = (1e-6, -1, -1)
    if depth and len(rows) >= 2 * least:
        width = binned.shape[1]
        flat = (binned[rows] + np.arange(width) * bins).ravel()
        sums = [np.bincount(flat, np.repeat(v[rows], width) if v is not None else None, width * bins).reshape(width, bins).cumsum(axis=1) for v in (g, h, None)]
        left_g, left_h, left_n = sums
        right_g, right_h, right_n = total_g - left_g, total_h - left_h, len(rows) - left_n
        gain = left_g**2 / (left_h + penalty) + right_g**2 / (right_h + penalty) - total_g**2 / (total_h + penalty)
        gain[(left_n < least) | (right_n < least)] = 0
        for f, e in enumerate(edges):
            gain[f, len(e) :] = 0
        f, b = np.unravel_index(np.argmax(gain), gain.shape)
        best = max(best, (float(gain[f, b]), int(f), int(b)))
    if best[1] < 0:
        nodes[me][4] = rate * total_g / (total_h + penalty)
        raw[rows] += nodes[me][4]
        return me
    _, f, b = best
    goes_left = binned[rows, f] <= b
    children = [_grow(nodes, binned, edges, g, h, part, depth - 1, bins, least, penalty, rate, raw) for part in (rows[goes_left], rows[~goes_left])]
    nodes[me] = [f, edges[f][b], *children, 0.0]
    return me
