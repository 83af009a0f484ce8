"""Recursive and linear models as array expressions: Holt-Winters, damped Holt-Winters, ridge.

Each builds one SQL expression over the array of a series' history, so fitting is a
narrow projection inside the JVM: the smoothing recursion is a fold over the months
for every point of the parameter grid, ridge is a small dense solve (normal equations
and Gauss-Jordan elimination).  Work and memory of a row are bounded by the calendar
and the grid; rows are independent.

A history that is too short, or one with a null month, gives a null forecast.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from .. import settings as S
from . import backtest as B
from .smoothing import DAMPINGS, LEVELS, RIDGE_ALPHAS, SEASONALS, TRENDS


def let(body: str, **values: str) -> str:
    """``body`` with names for values, each computed once; later ones may use earlier ones."""
    for name, value in reversed(values.items()):
        body = f"transform(array({value}), {name} -> {body})[0]"
    return body


def _doubles(values: Sequence[float]) -> str:
    return f"array({', '.join(f'{float(v)!r}D' for v in values)})"


def _sum(values: str) -> str:
    return f"aggregate({values}, 0D, (acc_, v_) -> acc_ + v_)"


def _mean(values: str) -> str:
    return f"({_sum(values)} / size({values}))"


def _dot(a: str, b: str) -> str:
    return _sum(f"zip_with({a}, {b}, (a_, b_) -> a_ * b_)")


# --------------------------------------------------------------------------
# exponential smoothing
# --------------------------------------------------------------------------
def _smoothing(history: str, horizon: int, dampings: Sequence[float], season: int) -> str:
    cycles = f"sequence(0, size(y) div {season} - 1)"
    grid = "p_level -> flatten(transform({t}, p_trend -> flatten(transform({s}, p_season -> transform({d}, p_damp -> {p})))))"
    point = "named_struct('alpha', p_level, 'beta', p_trend, 'gamma', p_season, 'phi', p_damp)"
    points = grid.format(t=_doubles(TRENDS), s=_doubles(SEASONALS), d=_doubles(dampings), p=point)
    # the seasonal terms are a queue: the coming month's is in front
    expected = "(w.level + g.phi * w.slope)"
    step = let(
        f"""named_struct('level', {expected} + g.alpha * miss, 'slope', g.phi * w.slope + g.beta * g.alpha * miss,
            'season', concat(slice(w.season, 2, {season - 1}), array(w.season[0] + g.gamma * (1D - g.alpha) * miss)),
            'sse', w.sse + miss * miss)""",
        miss=f"value - {expected} - w.season[0]",
    )
    walk = f"aggregate(y, named_struct('level', level0, 'slope', slope0, 'season', season0, 'sse', 0D), (w, value) -> {step})"
    # the least error wins, the first of the grid among equals
    best = f"""array_min(transform(flatten(transform({_doubles(LEVELS)}, {points})), (g, k) -> {let(
        "named_struct('sse', end.sse, 'k', k, 'phi', g.phi, 'level', end.level, 'slope', end.slope, 'season', end.season)",
        end=walk)}))"""
    reach = "if(best.phi = 1D, cast(ahead AS double), best.phi * (1D - power(best.phi, ahead)) / (1D - best.phi))"
    ahead = f"best.level + best.slope * {reach} + best.season[(ahead - 1) % {season}]"
    forecast = let(
        f"if(best.sse IS NULL, NULL, transform(sequence(1, {horizon}), ahead -> greatest({ahead}, 0D)))",
        means=f"transform({cycles}, c -> {_mean(f'slice(y, c * {season} + 1, {season})')})",
        slope0=f"(means[1] - means[0]) / {season}",
        level0=f"means[0] - slope0 * {season - 1} / 2 - slope0",
        gaps=f"transform(sequence(0, {season - 1}), s -> {_mean(f'transform({cycles}, c -> y[c * {season} + s] - means[c])')})",
        season0=f"transform(gaps, gap -> gap - {_mean('gaps')})",
        best=best,
    )
    return let(f"if(size(y) < {2 * season}, NULL, {forecast})", y=f"cast({history} AS array<double>)")


def holt_winters(history: str, horizon: int) -> str:
    """Additive trend and season, never below zero."""
    return _smoothing(history, horizon, (1.0,), S.SEASON)


def holt_winters_damped(history: str, horizon: int) -> str:
    """Additive damped trend and season, never below zero."""
    return _smoothing(history, horizon, DAMPINGS, S.SEASON)


# --------------------------------------------------------------------------
# ridge regression
# --------------------------------------------------------------------------
def inverse(matrix: str, size: int) -> str:
    """Inverse of a symmetric positive definite matrix (array of rows) by elimination; needs no row exchange."""
    unit = f"transform(sequence(0, {size - 1}), j_ -> if(i_ = j_, 1D, 0D))"
    step = let(
        "transform(m_, (row_, i_) -> if(i_ = k_, pivot_, zip_with(row_, pivot_, (a_, p_) -> a_ - row_[k_] * p_)))",
        pivot_="transform(m_[k_], v_ -> v_ / m_[k_][k_])",
    )
    wide = f"transform({matrix}, (row_, i_) -> concat(row_, {unit}))"
    done = f"aggregate(sequence(0, {size - 1}), {wide}, (m_, k_) -> {step})"
    return f"transform({done}, row_ -> slice(row_, {size + 1}, {size}))"


def ridge(history: str, horizon: int, alphas: Sequence[float] = RIDGE_ALPHAS, season: int = S.SEASON) -> str:
    """Ridge regression of ``log1p`` on a quadratic trend and month dummies, never below zero.

    The penalty is the one with the least leave-one-out error, which follows from the
    leverages.  The trend columns are divided by their reach and their penalties with
    them, which is the same regression with a well-conditioned matrix.
    """
    size = season + 2

    def features(t: str) -> str:
        months = f"transform(sequence(0, {season - 1}), s -> if({t} % {season} = s, 1D, 0D))"
        return f"concat(array({t} / n, ({t} / n) * ({t} / n)), {months})"

    penalty = "CASE i WHEN 0 THEN alpha / (n * n) WHEN 1 THEN alpha / (n * n * n * n) ELSE alpha END"
    penalised = f"transform(gram, (row, i) -> transform(row, (v, j) -> if(i = j, v + {penalty}, v)))"
    left_out = f"(target[r] - {_dot('x', 'w')}) / (1D - 1D / n - {_dot('x', f'transform(inv, row -> {_dot("row", "x")})')})"
    fitted = let(
        "named_struct('error', " + _mean("misses") + ", 'k', k, 'w', w)",
        inv=inverse(penalised, size),
        w=f"transform(inv, row -> {_dot('row', 'moment')})",
        misses=f"transform(rows, (x, r) -> power({left_out}, 2))",
    )
    ahead = let(_dot("x", "best.w"), x=f"zip_with({features('(size(y) + step)')}, centre, (a, b) -> a - b)")
    forecast = let(
        f"if(best.error IS NULL, NULL, transform(sequence(0, {horizon - 1}), step -> greatest(expm1({ahead} + mean), 0D)))",
        n="cast(size(y) AS double)",
        mean=_mean("transform(y, v -> log1p(v))"),
        target="transform(y, v -> log1p(v) - mean)",
        raw=f"transform(sequence(0, size(y) - 1), t -> {features('t')})",
        centre=f"transform(sequence(0, {size - 1}), j -> {_mean('transform(raw, row -> row[j])')})",
        rows="transform(raw, row -> zip_with(row, centre, (a, b) -> a - b))",
        columns=f"transform(sequence(0, {size - 1}), j -> transform(rows, row -> row[j]))",
        gram=f"transform(columns, a -> transform(columns, b -> {_dot('a', 'b')}))",
        moment=f"transform(columns, a -> {_dot('a', 'target')})",
        best=f"array_min(transform({_doubles(alphas)}, (alpha, k) -> {fitted}))",
    )
    return let(f"if(size(y) < 2, NULL, {forecast})", y=f"cast({history} AS array<double>)")


SqlForecast = Callable[[str, int], str]

#: models of this module by name
RECURSIVE_MODELS: dict[str, SqlForecast] = {"Holt-Winters": holt_winters, "HW Damped": holt_winters_damped}
RIDGE_MODEL: dict[str, SqlForecast] = {"Ridge": ridge}
#: what may be chosen for planning, and every array model that is known
CANDIDATES: dict[str, SqlForecast] = {**B.CANDIDATES, **RECURSIVE_MODELS}
MODELS: dict[str, SqlForecast] = {**B.SQL_MODELS, **RECURSIVE_MODELS, **RIDGE_MODEL}
