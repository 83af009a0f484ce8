"""Registrations to planning number."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from .. import settings as S
from ..functions.dates import months_between
from ..operators import array_models as A
from ..operators import backtest as B
from ..operators import forecast as FC
from ..operators import overlay as O
from ..operators import series as SE
from ..operators.cleaning import with_ev_flags, with_forecast_bucket
from ..session import materialise


class DemandPlan:
    """The chain from registrations to forecasts, scenarios and planning tables.

    The registrations are read once: the monthly series they reduce to (one
    row per month) is stored, and so is the forecast table (months x types),
    because many result tables branch off both.
    """

    def __init__(
        self,
        registrations: DataFrame,
        first_month: dt.date,
        last_month: dt.date,
        target_month: dt.date,
        focus_year: int = S.FOCUS_YEAR,
        year_shift: int = 0,
        initial: int = S.CV_INITIAL,
        step: int = S.CV_STEP,
        cv_horizon: int = S.CV_HORIZON,
        holdout: int = S.HOLDOUT_MONTHS,
        sql_models: Mapping[str, B.SqlForecast] | None = None,
        py_models: Mapping[str, B.PyForecast] | None = None,
        benchmarks: Mapping[str, B.SqlForecast] | None = None,
    ) -> None:
        self.registrations = registrations
        self.first_month, self.last_month, self.target_month = first_month, last_month, target_month
        self.focus_year, self.year_shift = focus_year, year_shift
        self.cv = {"initial": initial, "step": step, "horizon": cv_horizon}
        self.holdout = holdout
        # candidates may be chosen; benchmarks are only compared with
        self.sql_models = dict(A.CANDIDATES if sql_models is None else sql_models)
        self.py_models = dict(py_models or {})
        self.benchmarks = dict(B.SQL_MODELS if benchmarks is None else benchmarks)

    # ---- series
    @cached_property
    def wide(self) -> DataFrame:
        flagged = with_forecast_bucket(with_ev_flags(self.registrations))
        return materialise(SE.monthly_series(flagged, self.first_month, self.last_month))

    @property
    def horizon(self) -> int:
        return months_between(self.last_month, self.target_month)

    @property
    def first_forecast_year(self) -> int:
        return self.last_month.year

    def histories(self, wide: DataFrame) -> DataFrame:
        return SE.histories(SE.to_long(wide, list(S.MODELLED_SERIES)))

    @cached_property
    def training(self) -> DataFrame:
        return self.histories(SE.split_holdout(self.wide, self.holdout)[0])

    # ---- validation
    @cached_property
    def benchmark_cv(self) -> DataFrame:
        return B.backtest(self.training, self.benchmarks, **self.cv)

    @cached_property
    def benchmark_summary(self) -> DataFrame:
        return B.summarise(self.benchmark_cv)

    @cached_property
    def candidate_cv(self) -> DataFrame:
        return B.backtest(self.training, self.sql_models, **self.cv)

    @cached_property
    def python_cv(self) -> DataFrame:
        return B.backtest_python(self.training, self.py_models, **self.cv)

    @cached_property
    def summary(self) -> DataFrame:
        """Candidate summary: array models and, when given, Python models; fitted once, stored."""
        plain = materialise(B.summarise(self.candidate_cv)) if self.sql_models else None
        if not self.py_models:
            return plain
        fitted = materialise(B.summarise(self.python_cv))
        return fitted if plain is None else plain.unionByName(fitted)

    @cached_property
    def plan(self) -> DataFrame:
        return B.select_models(self.summary)

    @property
    def performance(self) -> DataFrame:
        return B.model_performance(self.plan, self.summary)

    # ---- forecasts
    @cached_property
    def modelled(self) -> DataFrame:
        return FC.forecast_detail(
            self.histories(self.wide), self.plan, self.sigma, self.horizon, self.py_models
        )

    @property
    def sigma(self) -> DataFrame:
        """Spread of each model: of candidates, and of the benchmarks that are none."""
        known = set(self.benchmarks) <= set(self.sql_models)
        return FC.sigma_table(self.summary, None if known else self.benchmark_summary)

    @cached_property
    def modelled_stored(self) -> DataFrame:
        return materialise(self.modelled)

    @property
    def detail(self) -> DataFrame:
        return FC.with_derived(self.modelled_stored)

    @property
    def long(self) -> DataFrame:
        return FC.forecast_long(self.detail)

    @property
    def observed(self) -> DataFrame:
        return FC.observed_in_last_year(self.wide, SE.WIDE_SERIES)

    @cached_property
    def annual(self) -> DataFrame:
        return materialise(FC.annual_summary(self.long, self.observed))

    # ---- overlay
    @property
    def drivers(self) -> DataFrame:
        return O.driver_assumptions(self.annual, self.first_forecast_year, self.target_month.year, self.year_shift)

    @cached_property
    def overlay(self) -> DataFrame:
        return O.overlay_monthly(self.long, self.drivers)

    @property
    def overlay_annual(self) -> DataFrame:
        return O.overlay_annual(self.overlay, self.observed)

    @property
    def overlay_delta(self) -> DataFrame:
        return O.overlay_delta(self.annual, self.overlay_annual, self.first_forecast_year, self.target_month.year)

    # ---- planning
    @property
    def planning(self) -> DataFrame:
        return FC.planning_summary(self.annual, self.focus_year)

    @property
    def planning_number(self) -> DataFrame:
        return FC.planning_number(self.planning)
