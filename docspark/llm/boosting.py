"""Gradient-boosted trees on bounded samples, kept as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Forest:
    """Trees of equal depth. Node k of a tree has the children 2k + 1 and 2k + 2; the arrays are (tree, node).

    A row goes right where its feature is above the threshold. A node that is not split sends all rows left.
    """

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Sum of leaf values of each row, all trees walked at once."""
        out = np.full(len(rows), self.base)
        trees = np.arange(len(self.feature))[None, :]
        for lo in range(0, len(rows), 4096):
            x = rows[lo : lo + 4096]
            at = np.zeros((len(x), len(self.feature)), np.int64)
            pick = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[pick, self.feature[trees, at]] > self.threshold[trees, at])
            out[lo : lo + 4096] += self.value[trees, at].sum(axis=1)
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.margin(rows))


def _edges(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower"))


def train(
    rows: np.ndarray,
    label: np.ndarray,
    monotone: dict[int, int] | None = None,
    trees: int = 80,
    depth: int = 3,
    rate: float = 0.15,
    ridge: float = 1.0,
    least: int = 5,
    bins: int = 64,
) -> Forest:
    """Fit a forest for a 0/1 label by Newton steps on histograms.

    ``monotone[f]`` is 1 or -1 where the score may only rise or fall with feature ``f``: a split that goes the other
    way is not made, and the values below each side stay on their side of the middle. No rows, or one label only,
    give a constant.
    """
    nodes, monotone = 2 ** (depth + 1) - 1, monotone or {}
    forest = Forest(np.zeros((0, nodes), np.int64), np.full((0, nodes), np.inf), np.zeros((0, nodes)), 0.0, depth)
    share = float(np.clip(label.mean(), 1e-3, 1 - 1e-3)) if len(label) else 0.5
    forest.base = float(np.log(share / (1 - share)))
    if len(np.unique(label)) < 2:
        return forest
    edges = [_edges(rows[:, f], bins) for f in range(rows.shape[1])]
    binned = np.column_stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)])
    margin = np.full(len(label), forest.base)
    feature, threshold, value = [], [], []
    for _ in range(trees):
        p = sigmoid(margin)
        grad, hess = label - p, np.maximum(p * (1 - p), 1e-6)
        f_, t_, v_ = np.zeros(nodes, np.int64), np.full(nodes, np.inf), np.zeros(nodes)
        low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        at = np.zeros(len(label), np.int64)
        v_[0] = np.clip(grad.sum() / (hess.sum() + ridge), low[0], high[0])
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            chosen = [None] * width
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                key, n = (at - first) * (len(e) + 1) + binned[:, f], width * (len(e) + 1)
                g, h, c = (np.bincount(key, w, n).reshape(width, -1).cumsum(axis=1) for w in (grad, hess, None))
                gl, hl, cl = g[:, :-1], h[:, :-1], c[:, :-1]
                gr, hr, cr = g[:, -1:] - gl, h[:, -1:] - hl, c[:, -1:] - cl
                lo, hi = low[first : first + width, None], high[first : first + width, None]
                left, right = np.clip(gl / (hl + ridge), lo, hi), np.clip(gr / (hr + ridge), lo, hi)
                own = np.clip(g[:, -1:] / (h[:, -1:] + ridge), lo, hi)
                worth = lambda v, gg, hh: gg * v - 0.5 * (hh + ridge) * v * v
                gain = worth(left, gl, hl) + worth(right, gr, hr) - worth(own, g[:, -1:], h[:, -1:])
                bad = (cl < least) | (cr < least)
                if f in monotone:
                    bad |= monotone[f] * (right - left) < 0
                gain = np.where(bad, 0, gain)
                cut = gain.argmax(axis=1)
                for k in range(width):
                    if gain[k, cut[k]] > best[k] + 1e-9:
                        best[k] = gain[k, cut[k]]
                        chosen[k] = (f, cut[k], left[k, cut[k]], right[k, cut[k]])
            step = np.zeros(len(label), np.int64)
            for k in range(width):
                node = first + k
                a, b = 2 * node + 1, 2 * node + 2
                low[[a, b]], high[[a, b]] = low[node], high[node]
                if chosen[k] is None:
                    v_[[a, b]] = v_[node]
                    continue
                f, cut, left, right = chosen[k]
                f_[node], t_[node], v_[a], v_[b] = f, edges[f][cut], left, right
                if f in monotone:
                    middle = (left + right) / 2
                    if monotone[f] > 0:
                        high[a], low[b] = middle, middle
                    else:
                        low[a], high[b] = middle, middle
                mine = at == node
                step[mine] = binned[mine, f] > cut
            at = 2 * at + 1 + step
        feature.append(f_)
        threshold.append(t_)
        value.append(rate * v_)
        margin += rate * v_[at]
    forest.feature, forest.threshold, forest.value = np.array(feature), np.array(threshold), np.array(value)
    return forest


def platt(margin: np.ndarray, label: np.ndarray, rounds: int = 200) -> tuple[float, float]:
    """(slope, offset) of the logistic curve that turns margins into calibrated probabilities."""
    a, b = 1.0, 0.0
    # targets pulled in from 0 and 1, so that separable margins keep a finite slope
    pos, neg = label.sum(), len(label) - label.sum()
    goal = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(rounds):
        p = sigmoid(a * margin + b)
        w = np.maximum(p * (1 - p), 1e-6)
        g = np.array([((goal - p) * margin).sum(), (goal - p).sum()])
        h = np.array([[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + np.clip(step[0], -1, 1), b + np.clip(step[1], -1, 1)
        if abs(step).max() < 1e-6:
            break
    return float(max(a, 1e-3)), float(b)
