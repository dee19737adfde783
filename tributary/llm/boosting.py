"""Gradient-boosted trees for a yes-or-no label, with monotonic constraints, scored from flat node arrays.

Trees are grown on binned columns from gradients and curvatures of the log loss. A column may be held to
rise (+1) or fall (-1) with the score: a split that would go the wrong way is not made, and what lies below
a split of such a column keeps to its side of the middle. A trained model is five numpy arrays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Trees:
    """Nodes of all trees, one tree of `2**(depth+1) - 1` nodes after the other, children of i at 2i+1, 2i+2.

    A row goes left where its column is at most the threshold. Leaves above the last level have an infinite
    threshold, so that every row walks `depth` steps.
    """

    depth: int
    base: float
    column: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row. All trees and rows are walked at once, a few thousand rows at a time."""
        size = (1 << self.depth + 1) - 1
        roots = np.arange(len(self.column) // size) * size
        out = np.full(len(x), self.base)
        for at in range(0, len(x) if len(roots) else 0, 4096):
            part = x[at : at + 4096]
            row = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(roots)), np.int64)
            for _ in range(self.depth):
                here = roots + node
                node = 2 * node + 1 + (part[row, self.column[here]] > self.threshold[here])
            out[at : at + 4096] += self.value[roots + node].sum(axis=1)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -40, 40)))


def fit(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.2,
    bins: int = 64, ridge: float = 1.0, least: float = 1.0,
) -> Trees:
    """Fit to rows x and labels y of 0 and 1. Without rows, or with one label only, the score is constant."""
    n, width = x.shape
    if n == 0:
        return Trees(depth, 0.0, *(np.empty(0, k) for k in (np.int64, np.float64, np.float64)))
    mean = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(mean / (1 - mean)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(width)]
    code = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], 1)
    span = bins + 1
    flat = code + np.arange(width) * span
    size = (1 << depth + 1) - 1
    columns, thresholds, values = [], [], []
    score = np.full(n, base)
    if y.min() == y.max():
        trees = 0
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = p - y, p * (1 - p)
        column, threshold, value = np.zeros(size, np.int64), np.full(size, np.inf), np.zeros(size)
        low, high = np.full(size, -np.inf), np.full(size, np.inf)
        node = np.zeros(n, np.int64)
        value[0] = np.clip(-g.sum() / (h.sum() + ridge), -4, 4)
        for level in range(depth):
            for k in range((1 << level) - 1, (1 << level + 1) - 1):
                rows = np.flatnonzero(node == k)
                best = _split(flat[rows], g[rows], h[rows], width, span, monotone, low[k], high[k], ridge, least) if len(rows) > 1 else None
                left, right = 2 * k + 1, 2 * k + 2
                low[left] = low[right] = low[k]
                high[left] = high[right] = high[k]
                if best is None:  # a leaf: all rows go left
                    value[left] = value[k]
                    node[rows] = left
                    continue
                j, cut, value[left], value[right] = best
                column[k], threshold[k] = j, edges[j][cut] if cut < len(edges[j]) else np.inf
                if monotone[j]:
                    middle = (value[left] + value[right]) / 2
                    (high if monotone[j] > 0 else low)[left] = middle
                    (low if monotone[j] > 0 else high)[right] = middle
                node[rows] = np.where(code[rows, j] <= cut, left, right)
        value *= rate
        score += value[node]
        columns.append(column)
        thresholds.append(threshold)
        values.append(value)
    parts = [np.concatenate(v) if v else np.empty(0, k) for v, k in ((columns, np.int64), (thresholds, float), (values, float))]
    return Trees(depth, base, *parts)


def _split(flat, g, h, width, span, monotone, low, high, ridge, least):
    """The best allowed split: (column, last bin on the left, value left, value right), or None."""
    at = flat.ravel()
    gs = np.bincount(at, np.repeat(g, width), width * span).reshape(width, span).cumsum(1)
    hs = np.bincount(at, np.repeat(h, width), width * span).reshape(width, span).cumsum(1)
    gl, hl, gr, hr = gs, hs, gs[:, -1:] - gs, hs[:, -1:] - hs
    vl, vr = (np.clip(np.clip(-a / (b + ridge), -4, 4), low, high) for a, b in ((gl, hl), (gr, hr)))

    def loss(a, b, v):
        return a * v + 0.5 * (b + ridge) * v * v

    whole = np.clip(np.clip(-gs[0, -1] / (hs[0, -1] + ridge), -4, 4), low, high)
    gain = loss(gs[0, -1], hs[0, -1], whole) - loss(gl, hl, vl) - loss(gr, hr, vr)
    wrong = (hl < least) | (hr < least) | (monotone[:, None] * (vr - vl) < 0)
    gain = np.where(wrong, -np.inf, gain)
    j, cut = np.unravel_index(int(np.argmax(gain)), gain.shape)
    return (int(j), int(cut), float(vl[j, cut]), float(vr[j, cut])) if gain[j, cut] > 1e-6 else None
