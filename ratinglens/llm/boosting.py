"""Gradient boosted trees of fixed depth for a yes or no, small enough to be fitted in a task and sent to others."""

import numpy as np

from .models import sigmoid

DEPTH = 3


def _best_split(binned: np.ndarray, edges: list[np.ndarray], gradient: np.ndarray, curvature: np.ndarray, ridge: float):
    """(gain, feature, edge) of the split of some rows that lowers the loss most."""
    best = (1e-9, -1, 0)
    whole = gradient.sum() ** 2 / (curvature.sum() + ridge)
    for feature, cuts in enumerate(edges):
        if len(cuts):
            g, h = (np.bincount(binned[:, feature], v, len(cuts) + 1).cumsum() for v in (gradient, curvature))
            gain = g[:-1] ** 2 / (h[:-1] + ridge) + (g[-1] - g[:-1]) ** 2 / (h[-1] - h[:-1] + ridge) - whole
            at = int(gain.argmax())
            best = max(best, (float(gain[at]), feature, at))
    return best


def boost(x: np.ndarray, y: np.ndarray, trees: int = 30, rate: float = 0.3, ridge: float = 1.0, cuts: int = 16) -> dict[str, np.ndarray]:
    """Trees as arrays: for each the features and limits of its inner nodes, level by level, and its leaves' values."""
    inner, leaves = (1 << DEPTH) - 1, 1 << DEPTH
    features, limits, values = np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, leaves))
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, cuts + 1)[1:-1])) for f in range(x.shape[1])]
    edges = [e[e < x[:, f].max()] for f, e in enumerate(edges)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], axis=1)
    margin = np.zeros(len(x))
    for tree in range(trees):
        p = sigmoid(margin)
        gradient, curvature, node = y - p, p * (1 - p), np.zeros(len(x), np.int64)
        for place in range(inner):
            rows = node == place
            goes_right = np.zeros(len(x), bool)
            if rows.any():
                _, feature, at = _best_split(binned[rows], edges, gradient[rows], curvature[rows], ridge)
                if feature >= 0:
                    features[tree, place], limits[tree, place] = feature, edges[feature][at]
                    goes_right = binned[:, feature] > at
            node = np.where(rows, 2 * node + 1 + goes_right, node)
        leaf = node - inner
        values[tree] = rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, curvature, leaves) + ridge)
        margin += values[tree][leaf]
    return {"features": features, "limits": limits, "values": values}


def predict(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    margin, rows = np.zeros(len(x)), np.arange(len(x))
    for features, limits, values in zip(model["features"], model["limits"], model["values"], strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, features[node]] > limits[node])
        margin += values[node - len(features)]
    return sigmoid(margin)
