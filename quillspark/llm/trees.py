"""Fitted MLlib trees as arrays, so that a task that has already parsed a text can score it without another shuffle."""

from __future__ import annotations

import numpy as np


def exported(tree) -> tuple[np.ndarray, ...]:
    """feature, threshold, left, right, value, confidence of an MLlib tree model; feature is -1 at leaves."""
    rows: list[list[float]] = []

    def walk(node) -> int:
        at = len(rows)
        rows.append([-1, 0.0, at, at, node.prediction(), 0.0])
        if node.getClass().getSimpleName() == "InternalNode":
            rows[at][0:2] = [node.split().featureIndex(), node.split().threshold()]
            rows[at][2] = walk(node.leftChild())
            rows[at][3] = walk(node.rightChild())
        else:
            stats = list(node.impurityStats().stats())
            rows[at][5] = stats[1] / sum(stats) if len(stats) == 2 and sum(stats) else 0.0
        return at

    walk(tree._java_obj.rootNode())
    a = np.array(rows, dtype=float)
    return a[:, 0].astype(int), a[:, 1], a[:, 2].astype(int), a[:, 3].astype(int), a[:, 4], a[:, 5]


def leaves(tree: tuple[np.ndarray, ...], x: np.ndarray) -> np.ndarray:
    """The leaf that each row of ``x`` falls into."""
    feature, threshold, left, right = tree[:4]
    at = np.zeros(len(x), dtype=int)
    rows = np.arange(len(x))
    while (inner := feature[at] >= 0).any():
        goes = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
        at = np.where(inner, np.where(goes, left[at], right[at]), at)
    return at


def forest_score(forest: list[tuple[np.ndarray, ...]], x: np.ndarray) -> np.ndarray:
    """Mean share of class 1 in the leaves of a classification forest."""
    return np.mean([t[5][leaves(t, x)] for t in forest], axis=0) if len(x) else np.zeros(0)


def boosted_score(forest: list[tuple[np.ndarray, ...]], weights: list[float], x: np.ndarray) -> np.ndarray:
    """Weighted sum of a boosted ensemble's trees."""
    return np.sum([w * t[4][leaves(t, x)] for t, w in zip(forest, weights, strict=True)], axis=0) if len(x) else np.zeros(0)
