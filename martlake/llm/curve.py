"""Logistic curve of one variable."""

from __future__ import annotations

import numpy as np


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_curve(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """``(slope, offset)`` of the logistic regression of ``y`` on ``x`` by Newton steps."""
    w = np.zeros(2)
    z = np.c_[x, np.ones(len(x))]
    for _ in range(50):
        p = sigmoid(z @ w)
        h = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(h, z.T @ (p - y) + ridge * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])
