"""Linear support vector machines and score calibration, fitted on bounded samples with numpy."""

from __future__ import annotations

import numpy as np

from billscope.llm.common import sigmoid


def fit_svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, c: float = 10.0, rounds: int = 30):
    """Weights and bias of a linear machine with squared hinge loss; ``y`` is -1 or 1.

    Newton's method on the rows inside the margin. With no more rows than columns each step is solved over rows
    (the Gram matrix, computed once in blocks of rows, so no copy of ``x`` is made), else over columns; both give the same machine.
    """
    weight = np.ones(len(x)) if weight is None else weight
    inside = np.ones(len(x), dtype=bool)
    if len(x) <= x.shape[1]:
        return fit_over_rows(x, y, weight, c, rounds)
    x1 = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    w = np.zeros(x1.shape[1])
    for _ in range(rounds):
        rows, target, loss = x1[inside], y[inside], c * weight[inside]
        if len(rows) < x1.shape[1]:
            gram = rows @ rows.T
            gram[np.diag_indices_from(gram)] += 1.0 / loss
            w = rows.T @ np.linalg.solve(gram, target.astype(np.float64))
        else:
            normal = (rows * loss[:, None]).T @ rows
            normal[np.diag_indices_from(normal)] += 1.0
            w = np.linalg.solve(normal, rows.T @ (loss * target))
        now = y * (x1 @ w) < 1
        if (now == inside).all() or not now.any():
            break
        inside = now
    return w[:-1], float(w[-1])


def fit_over_rows(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float, rounds: int, block: int = 256):
    """``fit_svm`` with one unknown per row; the bias is a column of ones, so a one in every product of rows."""
    starts = range(0, len(x), block)
    gram = np.empty((len(x), len(x)))
    for i in starts:
        rows = x[i : i + block].astype(np.float64)
        for j in starts:
            gram[i : i + block, j : j + block] = rows @ x[j : j + block].astype(np.float64).T + 1.0
    inside = np.ones(len(x), dtype=bool)
    share = np.zeros(len(x))
    for _ in range(rounds):
        at = np.flatnonzero(inside)
        part = gram[np.ix_(at, at)]
        part[np.diag_indices_from(part)] += 1.0 / (c * weight[at])
        share = np.zeros(len(x))
        share[at] = np.linalg.solve(part, y[at].astype(np.float64))
        now = y * (gram @ share) < 1
        if (now == inside).all() or not now.any():
            break
        inside = now
    w = np.zeros(x.shape[1])
    for i in starts:
        w += share[i : i + block] @ x[i : i + block].astype(np.float64)
    return w, float(share.sum())


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50):
    """Weights and bias of a logistic model (Newton steps); ``y`` is 0 or 1, smoothed as Platt proposes."""
    x1 = np.hstack([x, np.ones((len(x), 1))])
    n1, n0 = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    w = np.zeros(x1.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = sigmoid(x1 @ w)
        gradient = x1.T @ (p - target) + penalty * w
        hessian = (x1 * (p * (1 - p) + 1e-6)[:, None]).T @ x1 + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step * min(1.0, 5.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-7:
            break
    return w[:-1], float(w[-1])
