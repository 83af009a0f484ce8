"""Point forecasts by plan, intervals, totals, scenarios, years."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from .array_models import MODELS
from .backtest import FALLBACK_MODEL, PyForecast, run_models
from .quality import require_columns

BOUNDS = ["point_forecast", "lower_scenario", "upper_scenario", "lower95", "upper95"]
DETAIL = ["month", "vehicle_type", *BOUNDS, "selected_model"]


# --------------------------------------------------------------------------
# point forecasts and intervals
# --------------------------------------------------------------------------
def sigma_table(candidates: DataFrame, benchmarks: DataFrame | None = None) -> DataFrame:
    """Validation RMSE per series and model: candidates first, benchmarks for the rest."""
    first = candidates.selectExpr("Series", "Model", "RMSE AS _c")
    if benchmarks is None:
        return first.withColumnRenamed("_c", "sigma")
    second = benchmarks.selectExpr("Series", "Model", "RMSE AS _b")
    return first.join(second, ["Series", "Model"], "full").selectExpr("Series", "Model", "coalesce(_c, _b) AS sigma")


def planned_models(histories: DataFrame, plan: DataFrame) -> DataFrame:
    """One row per series and model of its plan; a series without plan uses the fallback model."""
    fallback = f"array(named_struct('Model', '{FALLBACK_MODEL}', 'weight', 1D))"
    zipped = "zip_with(models, weights, (m, w) -> named_struct('Model', m, 'weight', w))"
    name = (
        f"CASE WHEN models IS NULL THEN '{FALLBACK_MODEL}' WHEN size(models) = 1 THEN models[0]"
        " ELSE concat('Ensemble (', array_join(models, ', '), ')') END"
    )
    return histories.join(plan, "Series", "left").selectExpr(
        "Series", "history", "last_month", f"{name} AS selected_model",
        f"inline(if(models IS NULL, {fallback}, {zipped}))",
    )


def point_forecasts(
    planned: DataFrame, horizon: int, py_models: Mapping[str, PyForecast] | None = None
) -> DataFrame:
    """Add ``predicted``; names that are no known model, and models without a forecast, use the fallback."""
    sql = f"CASE Model {' '.join(f'''WHEN '{n}' THEN {f('history', horizon)}''' for n, f in MODELS.items())} END"
    sql = f"coalesce({sql}, {MODELS[FALLBACK_MODEL]('history', horizon)})"
    # a fit takes a while: the models of a few series should not share one task
    planned = planned.repartition(planned.sparkSession.sparkContext.defaultParallelism, "Series", "Model")
    if not py_models:
        return planned.selectExpr("*", f"{sql} AS predicted")
    named = F.col("Model").isin(*py_models)
    plain = planned.where(~named).selectExpr("*", f"{sql} AS predicted")
    fitted = [
        run_models(planned.where(F.col("Model") == name).drop("Model"), {name: f}, horizon, train="history").drop("error")
        for name, f in py_models.items()
    ]
    for part in fitted:
        plain = plain.unionByName(part)
    return plain


def forecast_detail(
    histories: DataFrame,
    plan: DataFrame,
    sigmas: DataFrame,
    horizon: int,
    py_models: Mapping[str, PyForecast] | None = None,
    scenario_z: float = S.SCENARIO_Z,
    reference_z: float = S.REFERENCE_Z,
) -> DataFrame:
    """Monthly forecast with scenario and reference bounds, whole numbers.

    An ensemble is the weighted sum of its models' forecasts; its sigma is the
    weighted sum of their validation errors.  Bounds widen with the square
    root of the step and the lower ones stop at zero.
    """
    predicted = point_forecasts(planned_models(histories, plan), horizon, py_models)
    stepped = predicted.join(sigmas, ["Series", "Model"], "left").selectExpr(
        "Series", "last_month", "selected_model", "weight", "coalesce(sigma, 0D) AS sigma",
        "posexplode(predicted) AS (_pos, _value)",
    )
    combined = stepped.groupBy("Series", "last_month", "selected_model", "_pos").agg(
        F.expr("sum(_value * weight) AS _point"), F.expr("sum(sigma * weight) AS _sigma")
    )
    spread = combined.selectExpr(
        "add_months(last_month, _pos + 1) AS month", "Series AS vehicle_type", "selected_model",
        "greatest(_point, 0D) AS point", "_sigma * sqrt(_pos + 1) AS sigma",
    )

    def whole(expr: str) -> str:
        return f"cast(bround({expr}) AS long)"

    return spread.selectExpr(
        "month", "vehicle_type",
        f"{whole('point')} AS point_forecast",
        f"{whole(f'greatest(point - {scenario_z!r}D * sigma, 0D)')} AS lower_scenario",
        f"{whole(f'point + {scenario_z!r}D * sigma')} AS upper_scenario",
        f"{whole(f'greatest(point - {reference_z!r}D * sigma, 0D)')} AS lower95",
        f"{whole(f'point + {reference_z!r}D * sigma')} AS upper95",
        "selected_model",
    )


# --------------------------------------------------------------------------
# derived series
# --------------------------------------------------------------------------
def rechargeable_totals(detail: DataFrame, parts: Sequence[str] = S.TARGET_SERIES) -> DataFrame:
    """Sum of the target series, bounds included."""
    return (
        detail.where(F.col("vehicle_type").isin(*parts))
        .groupBy("month")
        .agg(*(F.sum(b).alias(b) for b in BOUNDS))
        .selectExpr("month", f"'{S.TOTAL}' AS vehicle_type", *BOUNDS, "'Aggregated' AS selected_model")
    )


def pivot_bounds(detail: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """One row per month, five columns per vehicle type named ``bound_type``."""
    wide = detail.groupBy("month").pivot("vehicle_type", list(kinds)).agg(*(F.sum(b).alias(b) for b in BOUNDS))
    return wide.withColumnsRenamed({f"{k}_{b}": f"{b}_{k}" for k in kinds for b in BOUNDS})


def other_cars(detail: DataFrame, whole: str = S.ALL_CARS, part: str = S.ELECTRIFIED) -> DataFrame:
    """Whole minus part with crossed bounds: the low bound subtracts the high one and vice versa."""
    both = detail.where(F.col("vehicle_type").isin(whole, part))
    opposite = {
        "point_forecast": "point_forecast",
        "lower_scenario": "upper_scenario",
        "upper_scenario": "lower_scenario",
        "lower95": "upper95",
        "upper95": "lower95",
    }
    return pivot_bounds(both, [whole, part]).selectExpr(
        "month",
        f"'{S.NORMAL_CARS}' AS vehicle_type",
        *(f"if({a}_{whole} IS NULL OR {b}_{part} IS NULL, NULL, greatest({a}_{whole} - {b}_{part}, 0)) AS {a}"
          for a, b in opposite.items()),
        f"'Derived: {whole} - {part}' AS selected_model",
    )


def with_derived(detail: DataFrame) -> DataFrame:
    """Modelled series, rechargeable totals and other cars in one table."""
    return detail.select(*DETAIL).unionByName(rechargeable_totals(detail)).unionByName(other_cars(detail))


# --------------------------------------------------------------------------
# scenarios and years
# --------------------------------------------------------------------------
def forecast_long(detail: DataFrame) -> DataFrame:
    """``month, vehicle_type, scenario, forecast``."""
    bounds = list(S.SCENARIO_OF_BOUND)
    names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in S.SCENARIO_OF_BOUND.items())
    return (
        detail.select("month", "vehicle_type", *bounds)
        .unpivot(["month", "vehicle_type"], bounds, "scenario", "forecast")
        .selectExpr("month", "vehicle_type", f"CASE scenario {names} ELSE scenario END AS scenario", "forecast")
    )


def forecast_wide(long: DataFrame, kinds: Sequence[str], scenario: str = "normal") -> DataFrame:
    """One column per vehicle type for one scenario."""
    return long.where(F.col("scenario") == scenario).groupBy("month").pivot("vehicle_type", list(kinds)).agg(F.sum("forecast"))


def observed_in_last_year(wide: DataFrame, series: Sequence[str]) -> DataFrame:
    """``year, vehicle_type, observed_total`` for the year of the last observed month."""
    last_year = F.year(wide.agg(F.max("month")).scalar())
    return (
        wide.where(F.year("month") == last_year)
        .select("month", *series)
        .unpivot("month", list(series), "vehicle_type", "v")
        .groupBy(F.year("month").alias("year"), "vehicle_type")
        .agg(F.sum("v").alias("observed_total"))
    )


def annual_summary(long: DataFrame, observed: DataFrame) -> DataFrame:
    """Forecast per year, type and scenario; the running year gets its observed months in every scenario."""
    yearly = long.groupBy(F.year("month").alias("year"), "vehicle_type", "scenario").agg(
        F.sum("forecast").alias("forecast_total")
    )
    return yearly.join(F.broadcast(observed), ["year", "vehicle_type"], "left").selectExpr(
        "year", "vehicle_type", "scenario",
        "cast(forecast_total + coalesce(observed_total, 0) AS long) AS forecast_total",
    )


def year_matrix(annual: DataFrame, year: int, kinds: Sequence[str]) -> DataFrame:
    """Scenario by vehicle type for one year."""
    return (
        annual.where(F.col("year") == year)
        .groupBy("scenario")
        .pivot("vehicle_type", list(kinds))
        .agg(F.sum("forecast_total").cast("long"))
    )


def market_share(wide: DataFrame, annual: DataFrame, first_forecast_year: int) -> DataFrame:
    """Yearly totals and shares: observed before the first forecast year, forecast from then on.

    The join keeps years of both sides under one ``year`` column.
    """
    kinds = [S.BEV, S.OTHER, S.TOTAL, S.ALL_CARS]
    seen = wide.groupBy(F.year("month").alias("year")).agg(
        F.count(F.lit(1)).alias("months_in_year"), *(F.sum(k).alias(f"o_{k}") for k in kinds)
    )
    ahead = (
        annual.where((F.col("scenario") == "normal") & F.col("vehicle_type").isin(*kinds))
        .groupBy("year")
        .pivot("vehicle_type", kinds)
        .agg(F.sum("forecast_total"))
        .withColumnsRenamed({k: f"f_{k}" for k in kinds})
    )
    finals = {k: f"if(year < {first_forecast_year}, o_{k}, f_{k})" for k in kinds}
    base = f"greatest({S.ALL_CARS}_final, 1)"
    return (
        seen.join(ahead, "year", "full")
        .selectExpr("year", "months_in_year", *(f"cast({sql} AS long) AS {k}_final" for k, sql in finals.items()))
        .selectExpr(
            "*",
            *(f"if({S.ALL_CARS}_final IS NULL, NULL, {k}_final / {base} * 100) AS {k}_share_pct" for k in kinds[:3]),
        )
    )


def observed_and_projected(wide: DataFrame, annual: DataFrame, first_forecast_year: int) -> DataFrame:
    """Rechargeable total per year, observed and projected, as one list of years."""
    seen = (
        wide.groupBy(F.year("month").alias("year"))
        .agg(F.sum(S.TOTAL).cast("long").alias("total"))
        .where(F.col("year") < first_forecast_year)
        .withColumn("kind", F.lit("observed"))
    )
    ahead = annual.where(
        (F.col("vehicle_type") == S.TOTAL) & (F.col("scenario") == "normal") & (F.col("year") >= first_forecast_year)
    ).selectExpr("year", "forecast_total AS total", "'projected' AS kind")
    return seen.unionByName(ahead)


# --------------------------------------------------------------------------
# planning numbers
# --------------------------------------------------------------------------
def planning_summary(annual: DataFrame, year: int, weight: float = S.HYBRID_CHARGING_WEIGHT) -> DataFrame:
    """Vehicles and charging demand per scenario for one year, pessimistic first."""
    require_columns(annual, ["year", "vehicle_type", "scenario", "forecast_total"])
    kinds = [S.BEV, S.OTHER, S.TOTAL]
    rank = " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(S.SCENARIOS))
    return (
        year_matrix(annual, year, kinds)
        .selectExpr(
            "scenario", *kinds,
            f"cast(round({S.BEV} + {weight!r}D * {S.OTHER}, 0) AS long) AS {S.DEMAND_METRIC}",
        )
        .orderBy(F.expr(f"CASE scenario {rank} ELSE 99 END"))
    )


def planning_number(summary: DataFrame, scenario: str = "normal") -> DataFrame:
    """One row with the demand of a scenario; running it fails when the scenario is absent."""
    message = f"no planning row for scenario {scenario}"
    found = F.max(F.when(F.col("scenario") == scenario, F.col(S.DEMAND_METRIC)))
    return summary.agg(
        F.when(found.isNotNull(), found).otherwise(F.raise_error(F.lit(message)).cast("long")).alias("planning_number")
    )


def weight_sensitivity(
    summary: DataFrame, year: int, scenario: str = "normal", weights: Sequence[float] = S.SENSITIVITY_WEIGHTS
) -> DataFrame:
    """Demand of one scenario under each distinct weight."""
    distinct = list(dict.fromkeys(round(float(w), 2) for w in weights))
    listed = ", ".join(f"{w!r}D" for w in distinct)
    return (
        summary.where(F.col("scenario") == scenario)
        .selectExpr(f"{year} AS year", "scenario", f"explode(array({listed})) AS charging_weight", S.BEV, S.OTHER)
        .selectExpr("*", f"cast(round({S.BEV} + charging_weight * {S.OTHER}, 0) AS long) AS {S.DEMAND_METRIC}")
    )
