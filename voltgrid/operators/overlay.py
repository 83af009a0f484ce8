"""Macro and battery overlay on the scenario forecasts.  Column arithmetic only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from .quality import require_columns
from .tables import driver_path

OVERLAY = [
    "month",
    "year",
    "vehicle_type",
    "scenario",
    "base_forecast",
    "adjusted_forecast",
    "adjustment_multiplier",
    "macro_adjustment_multiplier",
    "battery_adjustment_multiplier",
]


def _bounded(expr: str, bounds: tuple[float, float]) -> str:
    return f"least(greatest({expr}, {bounds[0]!r}D), {bounds[1]!r}D)"


def saturation_factor(base: str, ceiling: float = S.SATURATION_CEILING) -> str:
    """Shrinks growth as the yearly total nears the ceiling; one where the total is unknown."""
    raw = f"1D - {S.SATURATION_WEIGHT!r}D * pow({base} / {ceiling!r}D, {S.SATURATION_EXPONENT!r}D)"
    return f"if({base} IS NULL, 1D, {_bounded(raw, S.SATURATION_BOUNDS)})"


def macro_multiplier() -> str:
    """Weighted deviations from neutral levels, bounded, times saturation, bounded again."""
    terms = " + ".join(f"{w!r}D * ({d} - {neutral!r}D)" for d, (w, neutral) in S.MACRO_WEIGHTS.items())
    return _bounded(f"{_bounded(f'1D + {terms}', S.MACRO_RAW_BOUNDS)} * saturation_factor", S.MACRO_BOUNDS)


def battery_multiplier() -> str:
    """Response of a series to the battery price, by scenario pass-through."""
    sensitivity = " ".join(f"WHEN '{k}' THEN {v!r}D" for k, v in S.BATTERY_SENSITIVITY.items())
    passed = " ".join(f"WHEN '{k}' THEN {v!r}D" for k, v in S.BATTERY_PASS_THROUGH.items())
    change = f"({S.BATTERY_REFERENCE_PRICE!r}D - battery_pack_usd_per_kwh) / {S.BATTERY_REFERENCE_PRICE!r}D"
    raw = f"1D + CASE vehicle_type {sensitivity} ELSE 0D END * CASE scenario {passed} ELSE 1D END * ({change})"
    return f"if(battery_pack_usd_per_kwh IS NULL, NULL, {_bounded(raw, S.BATTERY_BOUNDS)})"


def driver_assumptions(
    annual: DataFrame,
    first_year: int,
    last_year: int,
    year_shift: int = 0,
    scenarios: Sequence[str] = S.SCENARIOS,
    ceiling: float = S.SATURATION_CEILING,
) -> DataFrame:
    """Drivers per year and scenario with saturation and macro multiplier.

    Scenario offsets are fixed values, so each path row is opened into its
    scenarios in place.
    """
    require_columns(annual, ["year", "vehicle_type", "scenario", "forecast_total"])
    offsets = ", ".join(
        "named_struct('scenario', '{}', {})".format(
            s, ", ".join(f"'d_{d}', {v!r}D" for d, v in zip(S.DRIVERS, S.SCENARIO_DELTAS[s]))
        )
        for s in scenarios
    )
    path = (
        driver_path(annual.sparkSession, year_shift)
        .where(F.col("year").between(first_year, last_year))
        .selectExpr("*", f"inline(array({offsets}))")
        .selectExpr("year", "scenario", *(f"{d} + d_{d} AS {d}" for d in S.DRIVERS))
    )
    base = annual.where(F.col("vehicle_type") == S.TOTAL).selectExpr(
        "year", "scenario", "cast(forecast_total AS double) AS _base"
    )
    return (
        path.join(base, ["year", "scenario"], "left")
        .selectExpr("year", "scenario", *S.DRIVERS, f"{saturation_factor('_base', ceiling)} AS saturation_factor")
        .selectExpr("*", f"{macro_multiplier()} AS macro_adjustment_multiplier")
    )


def overlay_monthly(long: DataFrame, drivers: DataFrame, parts: Sequence[str] = S.TARGET_SERIES) -> DataFrame:
    """Adjusted monthly forecasts of the target series and their total.

    The product that is applied is not bounded; the multiplier that is
    reported is.  Totals carry the ratio of the sums and no component
    multipliers.
    """
    require_columns(long, ["month", "vehicle_type", "scenario", "forecast"])
    product = "macro_adjustment_multiplier * battery_adjustment_multiplier"
    series = (
        long.where(F.col("vehicle_type").isin(*parts))
        .selectExpr("month", "year(month) AS year", "vehicle_type", "scenario", "cast(forecast AS double) AS base_forecast")
        .join(F.broadcast(drivers), ["year", "scenario"], "left")
        .selectExpr("*", f"{battery_multiplier()} AS battery_adjustment_multiplier")
        .selectExpr(
            "month", "year", "vehicle_type", "scenario", "base_forecast",
            f"cast(round(if({product} IS NULL, NULL, greatest(base_forecast * {product}, 0D)), 0) AS long)"
            " AS adjusted_forecast",
            f"if({product} IS NULL, NULL, {_bounded(product, S.MACRO_BOUNDS)}) AS adjustment_multiplier",
            "macro_adjustment_multiplier",
            "battery_adjustment_multiplier",
        )
    )
    totals = (
        series.groupBy("month", "year", "scenario")
        .agg(F.sum("base_forecast").alias("base_forecast"), F.sum("adjusted_forecast").alias("adjusted_forecast"))
        .selectExpr(
            "month", "year", f"'{S.TOTAL}' AS vehicle_type", "scenario", "base_forecast", "adjusted_forecast",
            "adjusted_forecast / greatest(base_forecast, 1D) AS adjustment_multiplier",
            "cast(NULL AS double) AS macro_adjustment_multiplier",
            "cast(NULL AS double) AS battery_adjustment_multiplier",
        )
    )
    return series.unionByName(totals).select(*OVERLAY)


def overlay_annual(monthly: DataFrame, observed: DataFrame) -> DataFrame:
    """Adjusted and base totals per year; the running year gets its observed months."""
    yearly = monthly.groupBy("year", "vehicle_type", "scenario").agg(
        F.sum("adjusted_forecast").alias("_adjusted"), F.sum("base_forecast").alias("_base")
    )
    return yearly.join(F.broadcast(observed), ["year", "vehicle_type"], "left").selectExpr(
        "year", "vehicle_type", "scenario",
        "cast(_adjusted + coalesce(observed_total, 0) AS long) AS adjusted_forecast",
        "_base + coalesce(observed_total, 0) AS base_forecast_rebuilt",
    )


def overlay_delta(annual: DataFrame, adjusted: DataFrame, first_year: int, last_year: int) -> DataFrame:
    """Base against adjusted totals, absolute and in percent."""
    base = annual.where(
        F.col("year").between(first_year, last_year)
        & F.col("scenario").isin(*S.SCENARIOS)
        & F.col("vehicle_type").isin(*S.TARGET_SERIES, S.TOTAL)
    ).selectExpr("year", "scenario", "vehicle_type", "cast(forecast_total AS double) AS b")
    after = adjusted.selectExpr("year", "scenario", "vehicle_type", "cast(adjusted_forecast AS double) AS a")
    return base.join(after, ["year", "scenario", "vehicle_type"], "left").selectExpr(
        "year", "scenario", "vehicle_type",
        "cast(round(b, 0) AS long) AS base_forecast",
        "cast(round(a, 0) AS long) AS adjusted_forecast",
        "cast(round(a - b, 0) AS long) AS delta_absolute",
        "round((a - b) / greatest(b, 1D) * 100, 2) AS delta_pct",
    )


def waterfall(monthly: DataFrame, year: int, scenario: str = "normal") -> DataFrame:
    """Base, macro effect, battery effect and adjusted total of one year and scenario."""
    rows = monthly.where(
        (F.col("year") == year) & (F.col("scenario") == scenario) & F.col("vehicle_type").isin(*S.TARGET_SERIES)
    )
    return rows.agg(
        F.expr("sum(base_forecast) AS base"),
        F.expr("sum(base_forecast * macro_adjustment_multiplier) AS macro"),
        F.expr("cast(sum(adjusted_forecast) AS double) AS adjusted"),
    ).selectExpr(
        "stack(4, 1, 'Base', base, 2, 'Macro effect', macro - base, 3, 'Battery effect', adjusted - macro,"
        " 4, 'Adjusted', adjusted) AS (step, label, value)"
    )
