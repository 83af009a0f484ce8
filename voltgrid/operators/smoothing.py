"""Holt-Winters, damped Holt-Winters and ridge as Python functions, and their parameter grids.

The plans use the array expressions of ``array_models``; these are for callers with an
array in hand, and an example of models that are plugged in as Python.  Each call sees one series of at most a few hundred months; Spark spreads the
series and folds.  Holt-Winters searches a grid of smoothing parameters, all
grid points at once in NumPy vectors, so one pass over the months scores the
whole grid.
"""

from __future__ import annotations

import itertools

import numpy as np

from .. import settings as S

LEVELS = (0.05, 0.15, 0.3, 0.5, 0.7, 0.9)
TRENDS = (0.0, 0.01, 0.05, 0.15, 0.4)
SEASONALS = (0.0, 0.05, 0.15, 0.35, 0.7)
DAMPINGS = (0.80, 0.88, 0.94, 0.98)
RIDGE_ALPHAS = (0.1, 1.0, 10.0)


def _start(y: np.ndarray, season: int) -> tuple[float, float, np.ndarray]:
    """Level and slope from the first two seasons, seasonal terms as mean gaps to the season mean."""
    cycles = len(y) // season
    means = y[: cycles * season].reshape(cycles, season).mean(axis=1)
    slope = (means[1] - means[0]) / season
    gaps = y[: cycles * season].reshape(cycles, season) - means[:, None]
    seasonal = gaps.mean(axis=0)
    return means[0] - slope * (season - 1) / 2 - slope, slope, seasonal - seasonal.mean()


def _smooth(y: np.ndarray, horizon: int, dampings: tuple[float, ...], season: int) -> np.ndarray:
    if len(y) < 2 * season:
        raise ValueError(f"needs {2 * season} months, has {len(y)}")
    grid = np.array(list(itertools.product(LEVELS, TRENDS, SEASONALS, dampings))).T
    alpha, beta, gamma, phi = grid
    level0, slope0, seasonal0 = _start(y, season)
    level = np.full(alpha.shape, level0)
    slope = np.full(alpha.shape, slope0)
    seasonal = np.repeat(seasonal0[:, None], alpha.size, axis=1)
    sse = np.zeros(alpha.shape)
    for t, value in enumerate(y):
        s = seasonal[t % season]
        expected = level + phi * slope
        error = value - expected - s
        sse += error * error
        new_level = expected + alpha * error
        slope = phi * slope + beta * alpha * error
        seasonal[t % season] = s + gamma * (1 - alpha) * error
        level = new_level
    best = int(np.nanargmin(sse))
    steps = np.arange(1, horizon + 1)
    reach = np.cumsum(phi[best] ** steps)
    rows = (len(y) + steps - 1) % season
    return np.clip(level[best] + slope[best] * reach + seasonal[rows, best], 0, None)


def holt_winters(history: np.ndarray, horizon: int) -> np.ndarray:
    """Additive trend and season, never below zero."""
    return _smooth(history, horizon, (1.0,), S.SEASON)


def holt_winters_damped(history: np.ndarray, horizon: int) -> np.ndarray:
    """Additive damped trend and season, never below zero."""
    return _smooth(history, horizon, DAMPINGS, S.SEASON)


def _design(start: int, count: int, season: int) -> np.ndarray:
    t = np.arange(start, start + count)
    return np.column_stack([t, t**2, np.eye(season)[t % season]]).astype(float)


def ridge(history: np.ndarray, horizon: int) -> np.ndarray:
    """Ridge regression of ``log1p`` on a quadratic trend and month dummies.

    The penalty is the one with the least leave-one-out error, which follows
    from the hat matrix without refitting.
    """
    n, season = len(history), S.SEASON
    x, target = _design(0, n, season), np.log1p(history)
    centre, mean = x.mean(axis=0), target.mean()
    u, d, vt = np.linalg.svd(x - centre, full_matrices=False)
    projected = u.T @ (target - mean)

    def fit(penalty: float) -> tuple[float, np.ndarray]:
        shrink = d**2 / (d**2 + penalty)
        residual = target - mean - u @ (shrink * projected)
        leverage = (u**2) @ shrink + 1.0 / n
        coefficients = vt.T @ (d / (d**2 + penalty) * projected)
        return float(np.mean((residual / (1 - leverage)) ** 2)), coefficients

    _, coefficients = min((fit(a) for a in RIDGE_ALPHAS), key=lambda f: f[0])
    future = (_design(n, horizon, season) - centre) @ coefficients + mean
    return np.clip(np.expm1(future), 0, None)


#: Python models by name; add an entry to plug one in
PY_MODELS = {"Holt-Winters": holt_winters, "HW Damped": holt_winters_damped}
RIDGE_MODEL = {"Ridge": ridge}
