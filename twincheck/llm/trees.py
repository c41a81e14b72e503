"""Gradient-boosted trees for a yes/no target, kept as flat node arrays."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class Boosting:
    """``monotone`` maps a feature's index to 1 (scores never fall as it rises) or -1 (they never rise)."""

    trees: int = 60
    depth: int = 4
    rate: float = 0.2
    ridge: float = 1.0
    least_weight: float = 1.0
    bins: int = 64
    monotone: dict[int, int] = field(default_factory=dict)


@dataclass
class Forest:
    """All trees' nodes one after another. A leaf has feature -1; the others send a row left where value <= cut."""

    base: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of yes, for all rows at once, level by level."""
        out = np.full(len(rows), self.base)
        at = np.arange(len(rows))
        for root in self.roots:
            node = np.full(len(rows), root)
            while True:
                feature = self.feature[node]
                inner = feature >= 0
                if not inner.any():
                    break
                below = rows[at, np.maximum(feature, 0)] <= self.cut[node]
                node = np.where(inner, np.where(below, self.left[node], self.right[node]), node)
            out += self.value[node]
        return out

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows)))


def _sums(codes: np.ndarray, weights: np.ndarray, bins: int) -> np.ndarray:
    """Sum of the weights by feature and bin."""
    features = codes.shape[1]
    slots = codes + np.arange(features) * bins
    repeated = np.repeat(weights, features)
    return np.bincount(slots.ravel(), repeated, features * bins).reshape(features, bins)


def fit(rows: np.ndarray, target: np.ndarray, rule: Boosting = Boosting()) -> Forest:
    """Second-order boosting of the logistic loss on histograms.

    Constraints hold by construction: a split on a constrained feature whose sides are out of order is refused, and the
    midpoint of its sides bounds everything below. Rows of one class only, or none, give a forest without trees.
    """
    nodes: list[list[float]] = []
    roots: list[int] = []
    positive = float(target.sum())
    base = float(np.log((positive + 1) / (len(target) - positive + 1)))
    if 0 < positive < len(target):
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, rule.bins)[1:-1])) for column in rows.T]
        codes = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, rows.T)], axis=1)
        margin = np.full(len(target), base)
        for _ in range(rule.trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(len(nodes))
            _grow(nodes, margin, codes, cuts, target - p, p * (1 - p), rule)
    flat = np.array(nodes, dtype=float).reshape(-1, 5)
    return Forest(
        base, np.array(roots, dtype=int), flat[:, 0].astype(int), flat[:, 1],
        flat[:, 2].astype(int), flat[:, 3].astype(int), flat[:, 4],
    )


def _grow(nodes, margin, codes, cuts, gradient, weight, rule: Boosting) -> None:
    """Add one tree, and its values to the margins of the training rows."""

    def worth(g, h, low, high):
        value = np.clip(g / (h + rule.ridge), low, high)
        return value, g * value - 0.5 * (h + rule.ridge) * value**2

    todo = [(np.arange(len(gradient)), 0, -np.inf, np.inf, None)]
    while todo:
        own, depth, low, high, parent = todo.pop()
        here = len(nodes)
        nodes.append([-1, 0.0, 0, 0, 0.0])
        if parent is not None:
            nodes[parent[0]][parent[1]] = here
        g, h = gradient[own].sum(), weight[own].sum()
        value, gain_here = worth(g, h, low, high)
        best = None
        if depth < rule.depth and h >= 2 * rule.least_weight:
            left_g = np.cumsum(_sums(codes[own], gradient[own], rule.bins), axis=1)[:, :-1]
            left_h = np.cumsum(_sums(codes[own], weight[own], rule.bins), axis=1)[:, :-1]
            left_v, left_gain = worth(left_g, left_h, low, high)
            right_v, right_gain = worth(g - left_g, h - left_h, low, high)
            gain = left_gain + right_gain - gain_here
            gain[(left_h < rule.least_weight) | (h - left_h < rule.least_weight)] = -np.inf
            for feature, direction in rule.monotone.items():
                gain[feature, direction * (right_v[feature] - left_v[feature]) < 0] = -np.inf
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[f, b] > 1e-6 and b < len(cuts[f]):
                best = int(f), int(b), left_v[f, b], right_v[f, b]
        if best is None:
            nodes[here][4] = rule.rate * value
            margin[own] += rule.rate * value
            continue
        f, b, left_value, right_value = best
        nodes[here][:2] = [f, cuts[f][b]]
        below = codes[own, f] <= b
        bounds = [(low, high), (low, high)]
        if direction := rule.monotone.get(f, 0):
            middle = (left_value + right_value) / 2
            bounds = [(low, middle), (middle, high)] if direction > 0 else [(middle, high), (low, middle)]
        todo.append((own[below], depth + 1, *bounds[0], (here, 2)))
        todo.append((own[~below], depth + 1, *bounds[1], (here, 3)))
