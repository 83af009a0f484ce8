"""Rolling-origin validation and model choice.

A series is one row with its values as an array.  Folds, benchmark forecasts
and error measures are array expressions, so validation is a chain of narrow
projections: no self-joins, and Python only for models that are plugged in as such.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S

METRICS = ["RMSE", "MAE", "sMAPE", "WAPE", "MAPE"]


# --------------------------------------------------------------------------
# benchmark forecasts as SQL over an array
# --------------------------------------------------------------------------
def naive(history: str, horizon: int) -> str:
    """Last value."""
    return f"array_repeat(element_at({history}, -1), {horizon})"


def seasonal_naive(history: str, horizon: int, season: int = S.SEASON) -> str:
    """The last season again and again; a history shorter than a season falls back to the last value."""
    repeat = f"transform(sequence(0, {horizon - 1}), i -> element_at({history}, cast(i % {season} - {season} AS int)))"
    return f"if(size({history}) < {season}, {naive(history, horizon)}, {repeat})"


def drift(history: str, horizon: int) -> str:
    """Straight line through the first and last value."""
    last = f"element_at({history}, -1)"
    slope = f"(({last} - {history}[0]) / (size({history}) - 1))"
    line = f"transform(sequence(1, {horizon}), i -> {last} + i * {slope})"
    return f"if(size({history}) < 2, {naive(history, horizon)}, {line})"


SqlForecast = Callable[[str, int], str]

#: models that are plain array expressions; add an entry to plug one in
SQL_MODELS: dict[str, SqlForecast] = {"Naive": naive, "Seasonal Naive": seasonal_naive, "Drift": drift}
FALLBACK_MODEL = "Seasonal Naive"
#: the array models that may be chosen for planning; the others are benchmarks
CANDIDATES: dict[str, SqlForecast] = {FALLBACK_MODEL: seasonal_naive}


# --------------------------------------------------------------------------
# folds and error measures
# --------------------------------------------------------------------------
def folds(
    histories: DataFrame,
    initial: int = S.CV_INITIAL,
    step: int = S.CV_STEP,
    horizon: int = S.CV_HORIZON,
) -> DataFrame:
    """One row per series and fold: ``train`` before the origin, ``actual`` for ``horizon`` months after it."""
    origins = (
        f"if(size(history) - {horizon} >= {initial},"
        f" sequence({initial}, greatest(size(history) - {horizon}, {initial}), {step}), array())"
    )
    return histories.selectExpr("Series", "history", f"posexplode({origins}) AS (_pos, _origin)").selectExpr(
        "Series",
        "_pos + 1 AS Fold",
        "slice(history, 1, _origin) AS train",
        f"slice(history, _origin + 1, {horizon}) AS actual",
    )


def _mean(values: str) -> str:
    return f"aggregate({values}, 0D, (acc, v) -> acc + v) / size({values})"


def with_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Add the five error measures of two arrays."""
    eps = f"{S.METRIC_EPSILON!r}D"

    def pairs(body: str, source: str) -> str:
        return f"transform({source}, t -> {body})"

    zipped = f"zip_with({actual}, {predicted}, (a, p) -> named_struct('a', a, 'p', p))"
    gap = "abs(t.a - t.p)"
    absolute = pairs(gap, zipped)
    nonzero = f"filter({zipped}, t -> t.a != 0D)"
    relative = pairs("abs((t.a - t.p) / t.a)", nonzero)
    actual_sum = f"aggregate({actual}, 0D, (acc, v) -> acc + abs(v))"
    measures = {
        "RMSE": f"sqrt({_mean(pairs(f'{gap} * {gap}', zipped))})",
        "MAE": _mean(absolute),
        "sMAPE": f"{_mean(pairs(f'{gap} / ((abs(t.a) + abs(t.p)) / 2 + {eps})', zipped))} * 100",
        "WAPE": f"aggregate({absolute}, 0D, (acc, v) -> acc + v) / ({actual_sum} + {eps}) * 100",
        "MAPE": f"if(size({nonzero}) = 0, 0D, {_mean(relative)} * 100)",
    }
    return df.selectExpr("*", *(f"{sql} AS {name}" for name, sql in measures.items()))


def backtest(
    histories: DataFrame,
    models: Mapping[str, SqlForecast] | None = None,
    initial: int = S.CV_INITIAL,
    step: int = S.CV_STEP,
    horizon: int = S.CV_HORIZON,
) -> DataFrame:
    """One row per series, model and fold with the error measures; null ones where a model has no forecast."""
    chosen = models or SQL_MODELS
    cut = folds(histories, initial, step, horizon)
    if not set(chosen) <= set(SQL_MODELS):
        # a fit takes a while: the folds of a few series should not share one task
        cut = cut.repartition(histories.sparkSession.sparkContext.defaultParallelism, "Series", "Fold")
    rows = ", ".join(
        f"named_struct('Model', '{name}', 'predicted', {sql('train', horizon)})" for name, sql in chosen.items()
    )
    predicted = cut.selectExpr("Series", "Fold", "actual", f"inline(array({rows}))")
    return with_metrics(predicted).select("Series", "Model", "Fold", *METRICS)


PyForecast = Callable[[np.ndarray, int], np.ndarray]


def run_models(df: DataFrame, models: Mapping[str, PyForecast], horizon: int, train: str = "train") -> DataFrame:
    """Add a row per Python model with ``Model``, ``predicted`` and ``error``.

    Rows (a series or a fold each) are spread by hash and fitted in Arrow
    batches; a model that fails leaves its message instead of a forecast.
    """
    names = list(models)
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)

    def fit(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name in names:
                predicted, errors = [], []
                for values in batch[train]:
                    try:
                        predicted.append(models[name](np.asarray(values, dtype=float), horizon).tolist())
                        errors.append(None)
                    except Exception as error:  # noqa: BLE001 - the message is the result
                        predicted.append(None)
                        errors.append(f"{type(error).__name__}: {error}")
                yield batch.assign(Model=name, predicted=predicted, error=errors)

    spread = df.repartition(*[c for c in df.columns if c not in (train, "actual", "history")])
    return spread.mapInPandas(fit, f"{fields}, Model string, predicted array<double>, error string")


def backtest_python(
    histories: DataFrame,
    models: Mapping[str, PyForecast],
    initial: int = S.CV_INITIAL,
    step: int = S.CV_STEP,
    horizon: int = S.CV_HORIZON,
) -> DataFrame:
    """Like :func:`backtest` for Python models; failed fits have null measures and an ``error``."""
    fitted = run_models(folds(histories, initial, step, horizon), models, horizon)
    return with_metrics(fitted).select("Series", "Model", "Fold", *METRICS, "error")


def failures(results: DataFrame) -> DataFrame:
    """Series and models with a failed fit."""
    return results.where("error IS NOT NULL").groupBy("Series", "Model").agg(F.min("error").alias("Error"))


# --------------------------------------------------------------------------
# summary and choice
# --------------------------------------------------------------------------
def summarise(results: DataFrame) -> DataFrame:
    """Mean of each measure over the folds; models with a failed fold (no forecast) are left out."""
    means = [F.avg(m).alias(m) for m in METRICS]
    failed = F.count_if(F.col("RMSE").isNull()).alias("_failed")
    return results.groupBy("Series", "Model").agg(*means, failed).where("_failed = 0").drop("_failed")


def select_models(summary: DataFrame, tolerance: float = S.ENSEMBLE_TOLERANCE) -> DataFrame:
    """Per series the best model, or the best two weighted by inverse error.

    Models are ordered by RMSE, sMAPE, MAE (and name).  The runner-up joins
    when its RMSE is within ``tolerance`` of a best RMSE above zero.
    """
    ranked = summary.groupBy("Series").agg(
        F.sort_array(F.collect_list(F.struct("RMSE", "sMAPE", "MAE", "Model"))).alias("r")
    )
    ensemble = f"size(r) > 1 AND r[0].RMSE > 0 AND try_element_at(r, 2).RMSE <= r[0].RMSE * {tolerance!r}D"
    inverse = "(1 / r[0].RMSE + 1 / r[1].RMSE)"
    return ranked.selectExpr("Series", "r", f"coalesce({ensemble}, false) AS is_ensemble").selectExpr(
        "Series",
        "if(is_ensemble, 'ensemble', 'single') AS plan_type",
        "if(is_ensemble, array(r[0].Model, r[1].Model), array(r[0].Model)) AS models",
        f"if(is_ensemble, array(1 / r[0].RMSE / {inverse}, 1 / r[1].RMSE / {inverse}), array(1D)) AS weights",
    )


def model_performance(plan: DataFrame, summary: DataFrame) -> DataFrame:
    """Chosen model per series with its measures; an ensemble has a note instead."""
    single = plan.selectExpr("*", "if(plan_type = 'single', models[0], NULL) AS _model")
    measured = summary.selectExpr("Series", "Model AS _model", "RMSE", "MAE", "sMAPE")
    return single.join(measured, ["Series", "_model"], "left").selectExpr(
        "Series",
        "if(plan_type = 'ensemble', concat('Ensemble: ', array_join(models, ', ')), models[0]) AS Selected_Model",
        "plan_type = 'ensemble' AS Is_Ensemble",
        "RMSE AS CV_RMSE",
        "MAE AS CV_MAE",
        "sMAPE AS CV_sMAPE",
        "if(plan_type = 'ensemble', 'Weighted Avg Used', NULL) AS note",
    )
