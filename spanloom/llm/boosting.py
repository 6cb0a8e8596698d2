"""Gradient-boosted trees for two classes: trained in numpy, scored as a Column."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass
class Trees:
    """Trees are leaves (float) or (feature, threshold, tree below, tree at or above)."""

    start: float
    trees: list
    slope: float = 1.0
    shift: float = 0.0

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.full(len(rows), self.start)
        for tree in self.trees:
            total += _apply(tree, rows)
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.margin(rows) + self.shift)))

    def column(self, features: list[Column]) -> Column:
        """The calibrated probability as an expression over columns."""
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + _branch(tree, features)
        return 1 / (1 + F.exp(-(self.slope * total + self.shift)))


def _apply(tree, rows: np.ndarray) -> np.ndarray:
    if isinstance(tree, float):
        return np.full(len(rows), tree)
    feature, threshold, below, above = tree
    return np.where(rows[:, feature] < threshold, _apply(below, rows), _apply(above, rows))


def _branch(tree, features: list[Column]) -> Column:
    if isinstance(tree, float):
        return F.lit(tree)
    feature, threshold, below, above = tree
    return F.when(features[feature] < threshold, _branch(below, features)).otherwise(_branch(above, features))


def _grow(rows: np.ndarray, gradient: np.ndarray, curvature: np.ndarray, depth: int, rate: float, penalty: float):
    total, weight = gradient.sum(), curvature.sum()
    leaf = float(-rate * total / (weight + penalty))
    if depth == 0 or len(rows) < 8:
        return leaf
    best, choice = 1e-3, None
    for feature in range(rows.shape[1]):
        order = np.argsort(rows[:, feature], kind="stable")
        values = rows[order, feature]
        g, h = np.cumsum(gradient[order])[:-1], np.cumsum(curvature[order])[:-1]
        cut = np.flatnonzero(values[1:] > values[:-1])
        if not len(cut):
            continue
        gain = g[cut] ** 2 / (h[cut] + penalty) + (total - g[cut]) ** 2 / (weight - h[cut] + penalty) - total**2 / (weight + penalty)
        at = int(gain.argmax())
        if gain[at] > best:
            best, choice = gain[at], (feature, float((values[cut[at]] + values[cut[at] + 1]) / 2))
    if choice is None:
        return leaf
    below = rows[:, choice[0]] < choice[1]
    return (*choice, *(_grow(rows[part], gradient[part], curvature[part], depth - 1, rate, penalty) for part in (below, ~below)))


def boost(rows: np.ndarray, labels: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.25, penalty: float = 1.0) -> Trees:
    """Newton boosting of the logistic loss."""
    share = np.clip(labels.mean(), 0.01, 0.99)
    model = Trees(float(np.log(share / (1 - share))), [])
    margin = np.full(len(rows), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(rows, p - labels, np.maximum(1e-6, p * (1 - p)), depth, rate, penalty)
        model.trees.append(tree)
        margin += _apply(tree, rows)
    return model


def calibrate(model: Trees, rows: np.ndarray, labels: np.ndarray, rounds: int = 200) -> None:
    """Fits slope and shift of the margins to rows that training didn't see (Platt's method, smoothed targets)."""
    margin = model.margin(rows)
    good, bad = labels.sum(), (1 - labels).sum()
    target = np.where(labels == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    slope, shift = 1.0, 0.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(slope * margin + shift)))
        error, spread = p - target, np.maximum(1e-9, p * (1 - p))
        hessian = np.array([[(spread * margin**2).sum() + 1e-3, (spread * margin).sum()], [(spread * margin).sum(), spread.sum() + 1e-3]])
        step = np.linalg.solve(hessian, [(error * margin).sum(), error.sum()])
        slope, shift = slope - step[0], shift - step[1]
        if abs(step).max() < 1e-8:
            break
    model.slope, model.shift = float(slope), float(shift)


def threshold(probability: np.ndarray, labels: np.ndarray, precision: float) -> float:
    """The smallest probability at and over which at least that share of the rows are positive; over 1 if there is none."""
    best = 2.0
    for value in np.unique(probability)[::-1]:
        chosen = probability >= value
        if labels[chosen].mean() < precision:
            break
        best = float(value)
    return best
