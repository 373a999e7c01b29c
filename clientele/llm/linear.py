"""Small linear models fitted on the driver from a bounded sample (numpy only)."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float,
                 pairs: np.ndarray | None = None, pair_l2: float = 0.0,
                 steps: int = 25) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the last column of ``x`` is the intercept.

    ``pairs`` are feature differences between a row and its counterpart; the squared score
    difference of each is penalised with ``pair_l2`` (averaged over the rows of ``x``).
    """
    n, d = x.shape
    total = max(weight.sum(), 1e-12)
    ridge = np.full(d, l2)
    ridge[-1] = 1e-9
    fixed = np.diag(ridge)
    if pairs is not None and len(pairs):
        fixed = fixed + pair_l2 * (pairs.T @ pairs) / n
    w = np.zeros(d)
    for _ in range(steps):
        p = sigmoid(x @ w.astype(x.dtype))
        gradient = x.T @ (weight * (p - y)) / total + fixed @ w
        scaled = x * (weight * np.maximum(p * (1 - p), 1e-6) / total)[:, None].astype(x.dtype)
        curve = scaled.T @ x + fixed
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-5:
            break
    return w


def balanced(y: np.ndarray) -> np.ndarray:
    """Row weights under which both classes weigh the same."""
    share = y.mean() if len(y) else 0.5
    if share in (0.0, 1.0):
        return np.ones(len(y))
    return np.where(y > 0, 0.5 / share, 0.5 / (1 - share))


def fit_platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept that turn scores into probabilities."""
    if len(z) == 0 or y.min() == y.max():
        return 1.0, 0.0
    a, b = fit_logistic(np.column_stack([z, np.ones(len(z))]), y, np.ones(len(z)), 1e-4)
    return float(max(a, 1e-3)), float(b)
