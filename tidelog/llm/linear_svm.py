"""Linear hinge-loss models: dual coordinate descent, and scores from margins."""

from __future__ import annotations

import numpy as np


def dual_coordinate_descent(
    rows: list[tuple[np.ndarray, np.ndarray]],
    signs: np.ndarray,
    size: int,
    costs: np.ndarray,
    epochs: int = 12,
    seed: int = 1,
) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise |w|^2/2 + sum of costs * hinge loss.

    A row is its feature numbers and values; signs are 1 and -1. One dual
    variable at a time is moved to its optimum, in a new order each epoch; the
    bias is the weight of a constant feature.
    """
    weights, bias = np.zeros(size), 0.0
    alphas = np.zeros(len(rows))
    squares = np.array([float(v @ v) + 1.0 for _, v in rows])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in order.permutation(len(rows)):
            at, values = rows[i]
            gradient = signs[i] * (weights[at] @ values + bias) - 1.0
            new = min(max(alphas[i] - gradient / squares[i], 0.0), costs[i])
            step = (new - alphas[i]) * signs[i]
            if step:
                weights[at] += step * values
                bias += step
                alphas[i] = new
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return weights, bias


def logistic_scale(margins: np.ndarray, signs: np.ndarray, weights: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic score, fitted by Newton steps to smoothed targets."""
    up, down = weights[signs > 0].sum(), weights[signs < 0].sum()
    targets = np.where(signs > 0, (up + 1) / (up + 2), 1 / (down + 2))
    slope, offset = 1.0, float(np.log((up + 1) / (down + 1)))
    design = np.column_stack([margins, np.ones(len(margins))])

    def loss(a, b):
        z = a * margins + b
        return float(weights @ (np.logaddexp(0, z) - targets * z))

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
        gradient = design.T @ (weights * (p - targets))
        hessian = (design * (weights * p * (1 - p))[:, None]).T @ design + 1e-6 * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(slope - size * step[0], offset - size * step[1]) > loss(slope, offset):
            size /= 2
        slope, offset = slope - size * step[0], offset - size * step[1]
        if size * np.abs(step).max() < 1e-8:
            break
    return float(slope), float(offset)


def scores(margins: np.ndarray, slope: float, offset: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * margins + offset, -500, 500)))
