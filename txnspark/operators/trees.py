"""Boosted trees over binned cells within one task, grown and weighed as Spark's boosted trees are.

For many fits to the same points of which one task can hold all. A cell is the points of the same bins and label; they
have the same prediction, so a tree sees cells, and points only say what a subsample takes of a cell.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: What ``boosted_margins`` knows, with the values that hold where nothing is given.
DEFAULTS = {
    "maxDepth": 5,
    "stepSize": 0.1,
    "positiveWeight": 1.0,
    "subsamplingRate": 1.0,
    "featureSubset": 1.0,
    "minInstancesPerNode": 1,
    "minInfoGain": 0.0,
}
#: Impurity below which a node is of one value.
PURE = 2.0**-52


@dataclass(frozen=True)
class Cells:
    """``bins`` (features x cells) and ``label`` of cells; ``weight``, ``rows`` and ``fold`` of points, cell by cell."""

    bins: np.ndarray
    label: np.ndarray
    starts: np.ndarray
    weight: np.ndarray
    rows: np.ndarray
    fold: np.ndarray

    @classmethod
    def of(cls, bins: np.ndarray, label: np.ndarray, weight: np.ndarray, rows: np.ndarray, fold: np.ndarray) -> Cells:
        """From points in any order, always the same cells and points."""
        order = np.lexsort((rows, weight, fold, label, *bins))
        bins, label = bins[:, order], label[order]
        first = np.ones(len(order), dtype=bool)
        first[1:] = (label[1:] != label[:-1]) | (bins[:, 1:] != bins[:, :-1]).any(axis=0)
        starts = np.flatnonzero(first)
        return cls(bins[:, starts], label[starts], starts, weight[order], rows[order], fold[order])

    def sums(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values, self.starts, dtype=float)


def ratio(above: np.ndarray, below: np.ndarray) -> np.ndarray:
    return np.divide(above, below, out=np.zeros_like(above), where=below > 0)


def tree_values(
    bins: np.ndarray,
    weight: np.ndarray,
    count: np.ndarray,
    target: np.ndarray,
    depth: int,
    least_points: int,
    least_gain: float,
    subset: int,
    rng: np.random.Generator,
) -> np.ndarray:
    """For each cell the mean target of its leaf in a regression tree, cut by greatest fall of the variance.

    Cells of no weight are led to their leaves without a say. Each node looks at ``subset`` of the features.
    """
    sizes = bins.max(axis=1).astype(int) + 1
    value = np.zeros(len(weight))
    at, node, nodes = np.arange(len(weight)), np.zeros(len(weight), dtype=int), 1
    for level in range(depth + 1):
        w, c = weight[at], count[at]
        wy = w * target[at]
        all_w, all_wy, all_c = (np.bincount(node, v, nodes) for v in (w, wy, c))
        mean = ratio(all_wy, all_w)
        value[at] = mean[node]
        impurity = ratio(np.bincount(node, wy * target[at], nodes), all_w) - mean**2
        if level == depth:
            break
        looked = rng.random((nodes, len(bins))).argsort(axis=1).argsort(axis=1) < subset
        best, feature, last_left = np.zeros(nodes), np.zeros(nodes, dtype=int), np.zeros(nodes, dtype=int)
        for f, size in enumerate(sizes):
            if size < 2:
                continue
            place = node * size + bins[f, at]
            left_w, left_wy, left_c = (
                np.bincount(place, v, nodes * size).reshape(nodes, size).cumsum(axis=1)[:, :-1] for v in (w, wy, c)
            )
            right_w, right_wy, right_c = (a[:, None] - b for a, b in ((all_w, left_w), (all_wy, left_wy), (all_c, left_c)))
            gain = ratio(ratio(left_wy**2, left_w) + ratio(right_wy**2, right_w), all_w[:, None] + 0 * left_w)
            gain -= (mean**2)[:, None]
            gain[(left_c < least_points) | (right_c < least_points) | (gain < least_gain) | ~looked[:, f, None]] = 0.0
            cut = gain.argmax(axis=1)
            found = gain[np.arange(nodes), cut]
            better = found > best
            best[better], feature[better], last_left[better] = found[better], f, cut[better]
        goes_on = (best > 0) & (impurity > PURE)
        if not goes_on.any():
            break
        stays = goes_on[node]
        at, node = at[stays], node[stays]
        right = bins[feature[node], at] > last_left[node]
        node, nodes = (2 * (np.cumsum(goes_on) - 1))[node] + right, 2 * int(goes_on.sum())
    return value


def boosted_margins(cells: Cells, fold: int, params: dict, trees: int, seed: int) -> np.ndarray:
    """For each cell half the log odds that ``trees`` trees fitted to the points outside ``fold`` give.

    The first of the trees of more rounds are those of fewer.
    """
    given = {**DEFAULTS, **params}
    side = 2.0 * cells.label - 1.0
    factor = np.where(cells.label == 1, given["positiveWeight"], 1.0)
    subset = math.ceil(given["featureSubset"] * len(cells.bins))
    fitted = cells.fold != fold
    margin, target, rate = np.zeros(len(side)), side, given["subsamplingRate"]
    for k in range(trees):
        rng = np.random.default_rng((seed, k))
        if k == 0 or rate < 1:
            taken = fitted if rate >= 1 else fitted & (rng.random(len(fitted), dtype=np.float32) < rate)
            weight, count = cells.sums(cells.weight * taken) * factor, cells.sums(taken)
        value = tree_values(
            cells.bins, weight, count, target, given["maxDepth"], given["minInstancesPerNode"], given["minInfoGain"], subset, rng
        )
        margin = margin + (value if k == 0 else given["stepSize"] * value)
        target = 4.0 * side / (1.0 + np.exp(np.minimum(2.0 * side * margin, 700.0)))
    return margin


def area_under_pr(margin: np.ndarray, label: np.ndarray, rows: np.ndarray) -> float:
    """Area under the straight lines between the points of all thresholds; ``rows`` counts each margin."""
    order = np.argsort(-margin[rows > 0], kind="stable")
    margin, label, rows = (v[rows > 0][order] for v in (margin, label, rows))
    ends = np.flatnonzero(np.append(np.diff(margin) != 0, True)) if len(margin) else np.zeros(0, dtype=int)
    positives, flagged = np.cumsum(rows * label)[ends], np.cumsum(rows)[ends]
    if not len(ends) or positives[-1] == 0:
        return 0.0
    precision = positives / flagged
    return float(np.trapezoid(np.append(precision[0], precision), np.append(0.0, positives / positives[-1])))


def fold_score(cells: Cells, fold: int, params: dict, trees: int, seed: int) -> float:
    """Area under the precision-recall curve on ``fold`` of trees fitted to the other folds."""
    margin = boosted_margins(cells, fold, params, trees, seed)
    return area_under_pr(margin, cells.label, cells.sums(cells.rows * (cells.fold == fold)))
