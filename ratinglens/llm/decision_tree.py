"""A decision tree for a yes or no, fitted to a small labelled table and used as a Spark expression."""

from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Leaf:
    answer: bool


@dataclass(frozen=True)
class Split:
    """Rows with feature <= limit go low, all others high."""
    feature: int
    limit: float
    low: "Leaf | Split"
    high: "Leaf | Split"


def _impurity(yes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    share = yes / rows
    return rows * share * (1 - share)


def fit_tree(x: np.ndarray, y: np.ndarray, depth: int = 8, least: int = 2) -> "Leaf | Split":
    """Splits by Gini impurity while that lowers it and both sides keep ``least`` rows; of equal splits the first feature's
    and smallest limit's. A leaf answers as most of its rows, yes if equally many."""
    answer, best = Leaf(bool(2 * y.sum() >= len(y))), None
    if depth and 0 < y.sum() < len(y):
        for feature in range(x.shape[1]):
            order = np.argsort(x[:, feature], kind="stable")
            values, yes = x[order, feature], y[order].cumsum()
            at = np.flatnonzero(values[1:] > values[:-1]) + 1
            at = at[(at >= least) & (at <= len(y) - least)]
            if len(at):
                left = _impurity(yes[at - 1], at) + _impurity(yes[-1] - yes[at - 1], len(y) - at)
                k = int(left.argmin())
                if best is None or left[k] < best[0] - 1e-9:
                    best = (left[k], feature, float(values[at[k] - 1] + values[at[k]]) / 2)
    if best is None or best[0] >= _impurity(y.sum(), len(y)) - 1e-9:
        return answer
    _, feature, limit = best
    low = x[:, feature] <= limit
    below, above = fit_tree(x[low], y[low], depth - 1, least), fit_tree(x[~low], y[~low], depth - 1, least)
    return below if below == above and isinstance(below, Leaf) else Split(feature, limit, below, above)


def answer(tree: "Leaf | Split", row: Sequence[float]) -> bool:
    while isinstance(tree, Split):
        tree = tree.low if row[tree.feature] <= tree.limit else tree.high
    return tree.answer


def expression(tree: "Leaf | Split", feature: Callable[[int], Column]) -> Column:
    if isinstance(tree, Leaf):
        return F.lit(tree.answer)
    return F.when(feature(tree.feature) <= tree.limit, expression(tree.low, feature)).otherwise(expression(tree.high, feature))
