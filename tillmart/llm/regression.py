"""Logistic regression on a small table of features."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 50) -> np.ndarray:
    """Weights by Newton's method: intercept, then one per feature, then the features' scales."""
    scale = x.std(axis=0)
    scale[scale == 0] = 1.0
    rows = np.hstack([np.ones((len(x), 1)), x / scale])
    penalty = np.full(rows.shape[1], ridge)
    penalty[0] = 1e-6
    weights = np.zeros(rows.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - y) + penalty * weights
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        weights -= step
        if np.abs(step).max() < 1e-9:
            break
    return np.concatenate([weights, scale])


def logistic(x: np.ndarray, fitted: np.ndarray) -> np.ndarray:
    size = x.shape[1]
    weights, scale = fitted[: size + 1], fitted[size + 1 :]
    return 1 / (1 + np.exp(-np.clip(weights[0] + (x / scale) @ weights[1:], -30, 30)))
