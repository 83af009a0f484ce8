"""Validation, model choice, forecasts, scenarios, overlay, planning."""

import numpy as np
from pyspark.sql import functions as F

from ... import settings as S
from ...operators import array_models as A
from ...operators import backtest as B
from ...operators import forecast as FC
from ...operators import overlay as O
from ...operators import smoothing as SM
from .. import bindings as b
from ..demand import DemandPlan
from ..registry import query, sql, view
from . import series  # noqa: F401  (declares the series views)
from .views import values

N_MONTHS = 79
N_TRAIN = N_MONTHS - S.HOLDOUT_MONTHS
HORIZON = 65
YEARS = (b.LAST_MONTH.year, b.TARGET_MONTH.year)
METRICS = B.METRICS


def demand(spark, sf, **options) -> DemandPlan:
    return DemandPlan(
        b.registrations(spark, sf),
        b.FIRST_MONTH,
        b.LAST_MONTH,
        b.TARGET_MONTH,
        focus_year=b.FOCUS_YEAR,
        year_shift=b.YEAR_SHIFT,
        initial=b.CV_INITIAL,
        step=b.CV_STEP,
        cv_horizon=b.CV_HORIZON,
        **options,
    )


def rounded(df, digits=4, *columns):
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- validation --------------------------------------------------------------
view(
    "modelled",
    " UNION ALL ".join(
        f"SELECT '{s}' AS Series, month, CAST({s} AS DOUBLE) AS y,"
        f" row_number() OVER (ORDER BY month) - 1 AS pos FROM wide"
        for s in S.MODELLED_SERIES
    ),
    "wide",
)
view(
    "fold_points",
    f"""SELECT a.Series, CAST(f.fold AS INTEGER) AS Fold, i.i, a.y AS actual, l.y AS last_y, z.y AS first_y, s.y AS season_y, f.origin
        FROM (SELECT row_number() OVER (ORDER BY o) AS fold, o AS origin
              FROM range({b.CV_INITIAL}, {N_TRAIN - b.CV_HORIZON + 1}, {b.CV_STEP}) AS r(o)) f
        CROSS JOIN range(0, {b.CV_HORIZON}) AS i(i)
        JOIN modelled a ON a.pos = f.origin + i.i
        JOIN modelled l ON l.Series = a.Series AND l.pos = f.origin - 1
        JOIN modelled z ON z.Series = a.Series AND z.pos = 0
        JOIN modelled s ON s.Series = a.Series AND s.pos = f.origin - 12 + i.i % 12""",
    "modelled",
)
view(
    "fold_errors",
    """SELECT Series, Fold, i, actual, 'Naive' AS Model, last_y AS p FROM fold_points
       UNION ALL SELECT Series, Fold, i, actual, 'Seasonal Naive', season_y FROM fold_points
       UNION ALL SELECT Series, Fold, i, actual, 'Drift', last_y + (i + 1) * ((last_y - first_y) / (origin - 1))
       FROM fold_points""",
    "fold_points",
)
view(
    "cv",
    """SELECT Series, Model, Fold, sqrt(avg(pow(actual - p, 2))) AS RMSE, avg(abs(actual - p)) AS MAE,
              avg(abs(actual - p) / ((abs(actual) + abs(p)) / 2 + 1e-10)) * 100 AS sMAPE,
              sum(abs(actual - p)) / (sum(abs(actual)) + 1e-10) * 100 AS WAPE,
              coalesce(avg(CASE WHEN actual <> 0 THEN abs((actual - p) / actual) END) * 100, 0) AS MAPE
       FROM fold_errors GROUP BY Series, Model, Fold""",
    "fold_errors",
)
# ---- models that need recursion -------------------------------------------------------
HW_FORMS = {"Holt-Winters": (1.0,), "HW Damped": SM.DAMPINGS}


def _grid(values) -> str:
    return f"(VALUES {', '.join(f'({i}, CAST({v!r} AS DOUBLE))' for i, v in enumerate(values))})"


def holt_winters_views(model: str, dampings) -> None:
    """Every grid point walked month by month by a recursive statement; the one with the least error forecasts."""
    season, tag = S.SEASON, len(dampings)
    view(
        f"walks_{tag}",
        f"""SELECT h.Series, h.Fold, h.origin, g.*, 0 AS t, h.y, h.level, h.slope, h.seasonal, CAST(0 AS DOUBLE) AS sse
            FROM hw_start h CROSS JOIN (
                SELECT ((a.i * {len(SM.TRENDS)} + b.i) * {len(SM.SEASONALS)} + c.i) * {len(dampings)} + d.i AS point,
                       a.v AS alpha, b.v AS beta, c.v AS gamma, d.v AS phi
                FROM {_grid(SM.LEVELS)} a(i, v), {_grid(SM.TRENDS)} b(i, v), {_grid(SM.SEASONALS)} c(i, v), {_grid(dampings)} d(i, v)) g
            UNION ALL
            SELECT Series, Fold, origin, point, alpha, beta, gamma, phi, t + 1, y, expected + alpha * e, phi * slope + beta * alpha * e,
                   list_transform(seasonal, lambda v, i: CASE WHEN i = t % {season} + 1 THEN v + gamma * (1 - alpha) * e ELSE v END), sse + e * e
            FROM (SELECT *, level + phi * slope AS expected, y[t + 1] - (level + phi * slope) - seasonal[t % {season} + 1] AS e
                  FROM walks_{tag} WHERE t < origin)""",
        "hw_start",
    )
    view(
        f"hw_best_{tag}",
        f"""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Series, Fold ORDER BY sse, point) AS rn
                           FROM walks_{tag} WHERE t = origin) WHERE rn = 1""",
        f"walks_{tag}",
    )
    ahead = f"""greatest(level + slope * list_sum(list_transform(range(1, i.i + 1), lambda j: pow(phi, j)))
                         + seasonal[(origin + i.i - 1) % {season} + 1], 0) AS p"""
    view(
        f"hw_errors_{tag}",
        f"""SELECT w.Series, w.Fold, a.y AS actual, {ahead}
            FROM hw_best_{tag} w CROSS JOIN range(1, {b.CV_HORIZON + 1}) AS i(i)
            JOIN modelled a ON a.Series = w.Series AND a.pos = w.origin + i.i - 1 WHERE w.Fold > 0""",
        f"hw_best_{tag}",
        "modelled",
    )
    view(
        f"hw_cv_{tag}",
        f"""SELECT Series, '{model}' AS Model, Fold, sqrt(avg(pow(actual - p, 2))) AS RMSE, avg(abs(actual - p)) AS MAE,
              avg(abs(actual - p) / ((abs(actual) + abs(p)) / 2 + 1e-10)) * 100 AS sMAPE,
              sum(abs(actual - p)) / (sum(abs(actual)) + 1e-10) * 100 AS WAPE,
              coalesce(avg(CASE WHEN actual <> 0 THEN abs((actual - p) / actual) END) * 100, 0) AS MAPE
            FROM hw_errors_{tag} GROUP BY Series, Fold""",
        f"hw_errors_{tag}",
    )
    view(
        f"hw_points_{tag}",
        f"SELECT w.Series, i.i - 1 AS i, {ahead} FROM hw_best_{tag} w CROSS JOIN range(1, {HORIZON + 1}) AS i(i) WHERE w.Fold = 0",
        f"hw_best_{tag}",
    )


for _model, _dampings in HW_FORMS.items():
    holt_winters_views(_model, _dampings)
#: the folds, and as fold 0 the whole series
view(
    "hw_train",
    f"""SELECT m.Series, f.Fold, f.origin, list(m.y ORDER BY m.pos) AS y
        FROM (SELECT DISTINCT Fold, origin FROM fold_points UNION ALL SELECT 0, {N_MONTHS}) f
        JOIN modelled m ON m.pos < f.origin GROUP BY m.Series, f.Fold, f.origin""",
    "fold_points",
    "modelled",
)
view(
    "hw_means",
    f"""SELECT *, list_transform(range(0, origin // {S.SEASON}), lambda c: list_avg(y[c * {S.SEASON} + 1 : c * {S.SEASON} + {S.SEASON}])) AS means
        FROM hw_train""",
    "hw_train",
)
view(
    "hw_gaps",
    f"""SELECT *, (means[2] - means[1]) / {S.SEASON} AS slope,
               list_transform(range(1, {S.SEASON} + 1), lambda s: list_avg(list_transform(range(0, len(means)),
                   lambda c: y[c * {S.SEASON} + s] - means[c + 1]))) AS gaps FROM hw_means""",
    "hw_means",
)
view(
    "hw_start",
    f"""SELECT Series, Fold, origin, y, means[1] - slope * {S.SEASON - 1} / 2 - slope AS level, slope,
               list_transform(gaps, lambda g: g - list_avg(gaps)) AS seasonal FROM hw_gaps""",
    "hw_gaps",
)


# ---- summaries ---------------------------------------------------------------
_MEANS = ", ".join(f"avg({m}) AS {m}" for m in METRICS)
view("benchmark_summary", f"SELECT Series, Model, {_MEANS} FROM cv GROUP BY Series, Model", "cv")
#: the candidates: seasonal naive and the recursive models
view(
    "summary",
    f"""SELECT Series, Model, {_MEANS} FROM (
            SELECT * FROM cv WHERE Model = '{B.FALLBACK_MODEL}'
            {' '.join(f'UNION ALL SELECT * FROM hw_cv_{len(d)}' for d in HW_FORMS.values())})
        GROUP BY Series, Model""",
    "cv",
    *(f"hw_cv_{len(d)}" for d in HW_FORMS.values()),
)
_ROUND4 = ", ".join(f"round({m}, 4) AS {m}" for m in METRICS)


def _backtest(model: str):
    def run(spark, sf):
        return rounded(demand(spark, sf, benchmarks={model: B.SQL_MODELS[model]}).benchmark_cv, 4, *METRICS)

    return run


for _key, _model in (("naive", "Naive"), ("snaive", "Seasonal Naive"), ("drift", "Drift")):
    query(
        f"backtest_{_key}",
        sql(f"SELECT Series, Model, Fold, {_ROUND4} FROM cv WHERE Model = '{_model}'", "cv"),
    )(_backtest(_model))


@query("backtest_summary", sql(f"SELECT Series, Model, {_ROUND4} FROM summary", "summary"))
def backtest_summary(spark, sf):
    return rounded(demand(spark, sf).summary, 4, *METRICS)


# ---- model choice --------------------------------------------------------------
_RANK = "SELECT *, row_number() OVER (PARTITION BY Series ORDER BY RMSE, sMAPE, MAE, Model) AS rn"
view("ranked", f"{_RANK} FROM summary", "summary")
view("benchmark_ranked", f"{_RANK} FROM benchmark_summary", "benchmark_summary")
view(
    "chosen",
    f"""SELECT a.Series, a.Model AS m1, a.RMSE AS r1, z.Model AS m2, z.RMSE AS r2,
               coalesce(a.RMSE > 0 AND z.RMSE <= a.RMSE * {S.ENSEMBLE_TOLERANCE}, false) AS both_used
        FROM ranked a LEFT JOIN ranked z ON z.Series = a.Series AND z.rn = 2 WHERE a.rn = 1""",
    "ranked",
)
view(
    "weights",
    """SELECT Series, m1 AS Model, CASE WHEN both_used THEN (1 / r1) / (1 / r1 + 1 / r2) ELSE 1 END AS w, r1 AS sigma FROM chosen
       UNION ALL SELECT Series, m2, (1 / r2) / (1 / r1 + 1 / r2), r2 FROM chosen WHERE both_used""",
    "chosen",
)


@query(
    "model_selection",
    sql(
        """SELECT Series, CASE WHEN both_used THEN 'ensemble' ELSE 'single' END AS plan_type,
                  CASE WHEN both_used THEN m1 || '+' || m2 ELSE m1 END AS models,
                  round(CASE WHEN both_used THEN (1 / r1) / (1 / r1 + 1 / r2) ELSE 1 END, 6) AS first_weight
           FROM chosen""",
        "chosen",
    ),
)
def model_selection(spark, sf):
    return demand(spark, sf).plan.select(
        "Series", "plan_type", F.array_join("models", "+").alias("models"),
        F.round(F.col("weights")[0], 6).alias("first_weight"),
    )


@query(
    "best_model_per_series",
    sql("SELECT Series, Model, round(RMSE, 4) AS RMSE FROM ranked WHERE rn = 1", "ranked"),
)
def best_model_per_series(spark, sf):
    from ...operators.ranking import first_per_group

    order = [F.col(c) for c in ("RMSE", "sMAPE", "MAE", "Model")]
    best = first_per_group(demand(spark, sf).summary, ["Series"], order)
    return rounded(best.select("Series", "Model", "RMSE"), 4, "RMSE")


@query(
    "model_performance",
    sql(
        """SELECT c.Series, CASE WHEN both_used THEN 'Ensemble: ' || m1 || ', ' || m2 ELSE m1 END AS Selected_Model,
                  both_used AS Is_Ensemble,
                  CASE WHEN NOT both_used THEN round(s.RMSE, 4) END AS CV_RMSE,
                  CASE WHEN NOT both_used THEN round(s.MAE, 4) END AS CV_MAE,
                  CASE WHEN NOT both_used THEN round(s.sMAPE, 4) END AS CV_sMAPE,
                  CASE WHEN both_used THEN 'Weighted Avg Used' END AS note
           FROM chosen c JOIN summary s ON s.Series = c.Series AND s.Model = c.m1""",
        "chosen",
        "summary",
    ),
)
def model_performance(spark, sf):
    return rounded(demand(spark, sf).performance, 4, "CV_RMSE", "CV_MAE", "CV_sMAPE")


@query(
    "candidates_and_benchmarks",
    sql(
        """SELECT s.Series, 'Seasonal Naive' AS chosen, round(s.RMSE, 4) AS chosen_rmse, r.Model AS best_of_all,
                  round(r.RMSE, 4) AS best_rmse, r.RMSE < s.RMSE AS a_benchmark_is_better, round(n.RMSE, 4) AS naive_sigma
           FROM benchmark_summary s JOIN benchmark_ranked r ON r.Series = s.Series AND r.rn = 1
           JOIN benchmark_summary n ON n.Series = s.Series AND n.Model = 'Naive'
           WHERE s.Model = 'Seasonal Naive'""",
        "benchmark_summary",
        "benchmark_ranked",
    ),
)
def candidates_and_benchmarks(spark, sf):
    """A benchmark is never chosen, however good it is; its spread is known all the same."""
    from ...operators.ranking import first_per_group

    plan = demand(spark, sf, sql_models=B.CANDIDATES)
    order = [F.col(c) for c in ("RMSE", "sMAPE", "MAE", "Model")]
    best = first_per_group(plan.benchmark_summary, ["Series"], order).selectExpr("Series", "Model AS best_of_all", "RMSE AS best_rmse")
    chosen = plan.plan.selectExpr("Series", "models[0] AS chosen")
    sigma = plan.sigma
    own = sigma.selectExpr("Series", "Model AS chosen", "sigma AS chosen_rmse")
    naive = sigma.where("Model = 'Naive'").selectExpr("Series", "sigma AS naive_sigma")
    joined = chosen.join(best, "Series").join(own, ["Series", "chosen"]).join(naive, "Series")
    better = joined.withColumn("a_benchmark_is_better", F.col("best_rmse") < F.col("chosen_rmse"))
    out = better.select("Series", "chosen", "chosen_rmse", "best_of_all", "best_rmse", "a_benchmark_is_better", "naive_sigma")
    return rounded(out, 4, "chosen_rmse", "best_rmse", "naive_sigma")


# ---- forecasts -------------------------------------------------------------------
_HW_POINTS = {name: f"hw_points_{len(d)}" for name, d in HW_FORMS.items()}
view(
    "points",
    f"""SELECT w.Series, i.i, sum(w.w * CASE w.Model {' '.join(f"WHEN '{n}' THEN {v}.p" for n, v in _HW_POINTS.items())} ELSE s.y END) AS p,
               sum(w.w * w.sigma) AS sigma
        FROM weights w CROSS JOIN range(0, {HORIZON}) AS i(i)
        JOIN modelled s ON s.Series = w.Series AND s.pos = {N_MONTHS - 12} + i.i % 12
        {' '.join(f'JOIN {v} ON {v}.Series = w.Series AND {v}.i = i.i' for v in _HW_POINTS.values())}
        GROUP BY w.Series, i.i""",
    "weights",
    "modelled",
    *_HW_POINTS.values(),
)


def _whole(expr: str) -> str:
    return f"CAST(round_even({expr}, 0) AS BIGINT)"


_SZ, _RZ = repr(S.SCENARIO_Z), repr(S.REFERENCE_Z)
view(
    "bands",
    f"""SELECT CAST(DATE '{b.LAST_MONTH}' + to_months(CAST(i + 1 AS INTEGER)) AS DATE) AS month, p.Series AS vehicle_type,
               {_whole('greatest(p, 0)')} AS point_forecast,
               {_whole(f'greatest(greatest(p, 0) - {_SZ} * sigma * sqrt(i + 1), 0)')} AS lower_scenario,
               {_whole(f'greatest(p, 0) + {_SZ} * sigma * sqrt(i + 1)')} AS upper_scenario,
               {_whole(f'greatest(greatest(p, 0) - {_RZ} * sigma * sqrt(i + 1), 0)')} AS lower95,
               {_whole(f'greatest(p, 0) + {_RZ} * sigma * sqrt(i + 1)')} AS upper95,
               CASE WHEN both_used THEN 'Ensemble (' || m1 || ', ' || m2 || ')' ELSE m1 END AS selected_model
        FROM points p JOIN chosen c ON c.Series = p.Series""",
    "points",
    "chosen",
)
_SUMS = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in FC.BOUNDS)
view(
    "totals",
    f"""SELECT month, 'TOTAL_RECHARGEABLE' AS vehicle_type, {_SUMS}, 'Aggregated' AS selected_model
        FROM bands WHERE vehicle_type IN ('BEV', 'OTHER_RECHARGEABLE') GROUP BY month""",
    "bands",
)
view(
    "others",
    """SELECT a.month, 'NORMAL_CARS' AS vehicle_type,
              greatest(a.point_forecast - e.point_forecast, 0) AS point_forecast,
              greatest(a.lower_scenario - e.upper_scenario, 0) AS lower_scenario,
              greatest(a.upper_scenario - e.lower_scenario, 0) AS upper_scenario,
              greatest(a.lower95 - e.upper95, 0) AS lower95, greatest(a.upper95 - e.lower95, 0) AS upper95,
              'Derived: TOTAL_ALL_CARS - ELECTRIFIED_TOTAL' AS selected_model
       FROM bands a JOIN bands e ON e.month = a.month AND e.vehicle_type = 'ELECTRIFIED_TOTAL'
       WHERE a.vehicle_type = 'TOTAL_ALL_CARS'""",
    "bands",
)
view(
    "detail",
    "SELECT * FROM bands UNION ALL SELECT * FROM totals UNION ALL SELECT * FROM others",
    "bands",
    "totals",
    "others",
)


@query("forecast_bands", sql("SELECT * FROM bands", "bands"))
def forecast_bands(spark, sf):
    return demand(spark, sf).modelled


@query("forecast_totals", sql("SELECT * FROM totals", "totals"))
def forecast_totals(spark, sf):
    return FC.rechargeable_totals(demand(spark, sf).modelled)


@query("forecast_normal_cars", sql("SELECT * FROM others", "others"))
def forecast_normal_cars(spark, sf):
    return FC.other_cars(demand(spark, sf).modelled)


@query("forecast_detail", sql("SELECT * FROM detail", "detail"))
def forecast_detail(spark, sf):
    return demand(spark, sf).detail


view(
    "long",
    " UNION ALL ".join(
        f"SELECT month, vehicle_type, '{name}' AS scenario, {bound} AS forecast FROM detail"
        for bound, name in S.SCENARIO_OF_BOUND.items()
    ),
    "detail",
)


@query("forecast_long", sql("SELECT * FROM long", "long"))
def forecast_long(spark, sf):
    return demand(spark, sf).long


_KINDS = [S.BEV, S.OTHER, S.TOTAL, S.ALL_CARS, S.ELECTRIFIED, S.NORMAL_CARS]


def _pivot(source: str, value: str, index: str, where: str, kinds=_KINDS) -> str:
    cells = ", ".join(f"CAST(sum(CASE WHEN vehicle_type = '{k}' THEN {value} END) AS BIGINT) AS {k}" for k in kinds)
    return f"SELECT {index}, {cells} FROM {source} WHERE {where} GROUP BY {index}"


@query("forecast_wide", sql(_pivot("long", "forecast", "month", "scenario = 'normal'"), "long"))
def forecast_wide(spark, sf):
    return FC.forecast_wide(demand(spark, sf).long, _KINDS)


# ---- years -----------------------------------------------------------------------
view(
    "observed",
    " UNION ALL ".join(
        f"SELECT CAST({YEARS[0]} AS INTEGER) AS year, '{k}' AS vehicle_type, sum({k}) AS observed_total"
        f" FROM wide WHERE year(month) = {YEARS[0]}"
        for k in _KINDS
    ),
    "wide",
)
view(
    "annual",
    """SELECT y.year, y.vehicle_type, y.scenario, CAST(y.f + coalesce(o.observed_total, 0) AS BIGINT) AS forecast_total
       FROM (SELECT CAST(year(month) AS INTEGER) AS year, vehicle_type, scenario, sum(forecast) AS f
             FROM long GROUP BY 1, 2, 3) y
       LEFT JOIN observed o ON o.year = y.year AND o.vehicle_type = y.vehicle_type""",
    "long",
    "observed",
)


@query("annual_summary", sql("SELECT * FROM annual", "annual"))
def annual_summary(spark, sf):
    return demand(spark, sf).annual


@query(
    "focus_year_matrix", sql(_pivot("annual", "forecast_total", "scenario", f"year = {b.FOCUS_YEAR}"), "annual")
)
def focus_year_matrix(spark, sf):
    return FC.year_matrix(demand(spark, sf).annual, b.FOCUS_YEAR, _KINDS)


_SHARE = [S.BEV, S.OTHER, S.TOTAL, S.ALL_CARS]
view("ahead", _pivot("annual", "forecast_total", "year", "scenario = 'normal'", _SHARE), "annual")
view(
    "seen",
    "SELECT CAST(year(month) AS INTEGER) AS year, count(*) AS months_in_year, "
    + ", ".join(f"CAST(sum({k}) AS BIGINT) AS {k}" for k in _SHARE)
    + " FROM wide GROUP BY 1",
    "wide",
)
view(
    "shares",
    f"SELECT coalesce(s.year, a.year) AS year, s.months_in_year, "
    + ", ".join(
        f"CASE WHEN coalesce(s.year, a.year) < {YEARS[0]} THEN s.{k} ELSE a.{k} END AS {k}_final" for k in _SHARE
    )
    + " FROM seen s FULL JOIN ahead a ON a.year = s.year",
    "seen",
    "ahead",
)


@query(
    "market_share_by_year",
    sql(
        "SELECT *, "
        + ", ".join(f"round({k}_final / greatest({S.ALL_CARS}_final, 1) * 100, 6) AS {k}_share_pct" for k in _SHARE[:3])
        + " FROM shares",
        "shares",
    ),
)
def market_share_by_year(spark, sf):
    plan = demand(spark, sf)
    out = FC.market_share(plan.wide, plan.annual, plan.first_forecast_year)
    return rounded(out, 6, *(f"{k}_share_pct" for k in _SHARE[:3]))


@query(
    "observed_and_projected",
    sql(
        f"""SELECT year, TOTAL_RECHARGEABLE AS total, 'observed' AS kind FROM seen WHERE year < {YEARS[0]}
            UNION ALL SELECT year, TOTAL_RECHARGEABLE, 'projected' FROM ahead WHERE year >= {YEARS[0]}""",
        "seen",
        "ahead",
    ),
)
def observed_and_projected(spark, sf):
    plan = demand(spark, sf)
    return FC.observed_and_projected(plan.wide, plan.annual, plan.first_forecast_year)


# ---- overlay ---------------------------------------------------------------------
view("path", values([(y + b.YEAR_SHIFT, *v) for y, v in S.DRIVER_PATH.items()], ["year", *S.DRIVERS]))
view("deltas", values([(s, *v) for s, v in S.SCENARIO_DELTAS.items()], ["scenario", *S.DRIVERS]))
_RAW = " + ".join(f"{w} * (p.{d} + d.{d} - {n})" for d, (w, n) in S.MACRO_WEIGHTS.items())
_SATURATION = (
    f"CASE WHEN a.forecast_total IS NULL THEN 1.0 ELSE least(greatest(1 - {S.SATURATION_WEIGHT} * "
    f"pow(a.forecast_total / {S.SATURATION_CEILING}, {S.SATURATION_EXPONENT}), 0.9), 1.0) END"
)
view(
    "drivers",
    f"""SELECT *, least(greatest(least(greatest(raw, 0.9), 1.1) * saturation_factor, 0.85), 1.15) AS macro
        FROM (SELECT CAST(p.year AS INTEGER) AS year, d.scenario, {', '.join(f'CAST(p.{x} + d.{x} AS DOUBLE) AS {x}' for x in S.DRIVERS)},
                     CAST({_SATURATION} AS DOUBLE) AS saturation_factor, CAST(1 + {_RAW} AS DOUBLE) AS raw
              FROM path p CROSS JOIN deltas d
              LEFT JOIN annual a ON a.year = p.year AND a.scenario = d.scenario AND a.vehicle_type = 'TOTAL_RECHARGEABLE')""",
    "path",
    "deltas",
    "annual",
)


@query(
    "driver_assumptions",
    sql(
        "SELECT year, scenario, "
        + ", ".join(f"round({d}, 6) AS {d}" for d in S.DRIVERS)
        + ", round(saturation_factor, 9) AS saturation_factor, round(macro, 9) AS macro_adjustment_multiplier FROM drivers",
        "drivers",
    ),
)
def driver_assumptions(spark, sf):
    out = rounded(demand(spark, sf).drivers, 6, *S.DRIVERS)
    return rounded(out, 9, "saturation_factor", "macro_adjustment_multiplier")


view(
    "adjusted",
    """SELECT l.month, CAST(year(l.month) AS INTEGER) AS year, l.vehicle_type, l.scenario, CAST(l.forecast AS DOUBLE) AS base_forecast, d.macro,
              least(greatest(1 + CASE l.vehicle_type WHEN 'BEV' THEN 0.20 ELSE 0.08 END
                * CASE l.scenario WHEN 'pessimistic' THEN 0.85 WHEN 'normal' THEN 1.0 ELSE 1.15 END
                * ((108.0 - d.battery_pack_usd_per_kwh) / 108.0), 0.95), 1.08) AS battery
       FROM long l LEFT JOIN drivers d ON d.year = year(l.month) AND d.scenario = l.scenario
       WHERE l.vehicle_type IN ('BEV', 'OTHER_RECHARGEABLE')""",
    "long",
    "drivers",
)
view(
    "overlay0",
    """SELECT month, year, vehicle_type, scenario, base_forecast,
              CAST(round(greatest(base_forecast * macro * battery, 0)) AS BIGINT) AS adjusted_forecast,
              CAST(least(greatest(macro * battery, 0.85), 1.15) AS DOUBLE) AS adjustment_multiplier,
              CAST(macro AS DOUBLE) AS macro_adjustment_multiplier, CAST(battery AS DOUBLE) AS battery_adjustment_multiplier
       FROM adjusted""",
    "adjusted",
)
view(
    "overlay",
    """SELECT * FROM overlay0 UNION ALL
       SELECT month, year, 'TOTAL_RECHARGEABLE', scenario, sum(base_forecast), CAST(sum(adjusted_forecast) AS BIGINT),
              sum(adjusted_forecast) / greatest(sum(base_forecast), 1), NULL, NULL
       FROM overlay0 GROUP BY month, year, scenario""",
    "overlay0",
)
_MULTIPLIERS = ["adjustment_multiplier", "macro_adjustment_multiplier", "battery_adjustment_multiplier"]


@query(
    "overlay_monthly",
    sql(
        "SELECT month, year, vehicle_type, scenario, base_forecast, adjusted_forecast, "
        + ", ".join(f"round({m}, 9) AS {m}" for m in _MULTIPLIERS)
        + " FROM overlay",
        "overlay",
    ),
)
def overlay_monthly(spark, sf):
    return rounded(demand(spark, sf).overlay, 9, *_MULTIPLIERS)


view(
    "overlay_years",
    """SELECT v.year, v.vehicle_type, v.scenario, CAST(v.a + coalesce(o.observed_total, 0) AS BIGINT) AS adjusted_forecast,
              v.b + coalesce(o.observed_total, 0) AS base_forecast_rebuilt
       FROM (SELECT year, vehicle_type, scenario, sum(adjusted_forecast) AS a, sum(base_forecast) AS b
             FROM overlay GROUP BY 1, 2, 3) v
       LEFT JOIN observed o ON o.year = v.year AND o.vehicle_type = v.vehicle_type""",
    "overlay",
    "observed",
)


@query(
    "overlay_annual",
    sql(
        """SELECT year, vehicle_type, scenario, adjusted_forecast,
                  CAST(base_forecast_rebuilt AS DOUBLE) AS base_forecast_rebuilt FROM overlay_years""",
        "overlay_years",
    ),
)
def overlay_annual(spark, sf):
    return demand(spark, sf).overlay_annual


@query(
    "overlay_delta",
    sql(
        """SELECT a.year, a.scenario, a.vehicle_type, a.forecast_total AS base_forecast, o.adjusted_forecast,
                  o.adjusted_forecast - a.forecast_total AS delta_absolute,
                  round((o.adjusted_forecast - a.forecast_total) / greatest(a.forecast_total, 1) * 100, 2) AS delta_pct
           FROM annual a LEFT JOIN overlay_years o
             ON o.year = a.year AND o.scenario = a.scenario AND o.vehicle_type = a.vehicle_type
           WHERE a.vehicle_type IN ('BEV', 'OTHER_RECHARGEABLE', 'TOTAL_RECHARGEABLE')""",
        "annual",
        "overlay_years",
    ),
)
def overlay_delta(spark, sf):
    return demand(spark, sf).overlay_delta


@query(
    "overlay_waterfall",
    sql(
        f"""SELECT CAST(step AS INTEGER) AS step, label, round(value, 4) AS value FROM (
              SELECT sum(base_forecast) AS b, sum(base_forecast * macro_adjustment_multiplier) AS m,
                     CAST(sum(adjusted_forecast) AS DOUBLE) AS a
              FROM overlay WHERE year = {b.FOCUS_YEAR} AND scenario = 'normal' AND vehicle_type <> 'TOTAL_RECHARGEABLE') t,
            LATERAL (VALUES (1, 'Base', b), (2, 'Macro effect', m - b), (3, 'Battery effect', a - m), (4, 'Adjusted', a))
              AS v(step, label, value)""",
        "overlay",
    ),
)
def overlay_waterfall(spark, sf):
    return rounded(O.waterfall(demand(spark, sf).overlay, b.FOCUS_YEAR), 4, "value")


# ---- planning --------------------------------------------------------------------
view("focus", _pivot("annual", "forecast_total", "scenario", f"year = {b.FOCUS_YEAR}", _SHARE[:3]), "annual")
view(
    "planning",
    f"""SELECT *, CAST(round(BEV + {S.HYBRID_CHARGING_WEIGHT} * OTHER_RECHARGEABLE, 0) AS BIGINT) AS {S.DEMAND_METRIC}
        FROM focus""",
    "focus",
)


@query("planning_summary", sql("SELECT * FROM planning", "planning"))
def planning_summary(spark, sf):
    return demand(spark, sf).planning


@query(
    "planning_number",
    sql(f"SELECT {S.DEMAND_METRIC} AS planning_number FROM planning WHERE scenario = 'normal'", "planning"),
)
def planning_number(spark, sf):
    return demand(spark, sf).planning_number


@query(
    "weight_sensitivity",
    sql(
        f"""SELECT CAST({b.FOCUS_YEAR} AS INTEGER) AS year, scenario, CAST(w AS DOUBLE) AS charging_weight, BEV,
                   OTHER_RECHARGEABLE, CAST(round(BEV + w * OTHER_RECHARGEABLE, 0) AS BIGINT) AS {S.DEMAND_METRIC}
            FROM planning, (VALUES (0.25), (0.35), (0.5)) AS t(w) WHERE scenario = 'normal'""",
        "planning",
    ),
)
def weight_sensitivity(spark, sf):
    return FC.weight_sensitivity(demand(spark, sf).planning, b.FOCUS_YEAR)


# ---- single candidates --------------------------------------------------------------
def _candidate(models):
    def run(spark, sf):
        cv = rounded(demand(spark, sf, sql_models=models).candidate_cv, 4, *METRICS)
        return cv.withColumn("error", F.lit(None).cast("string"))

    return run


for _key, _model in (("holt_winters", "Holt-Winters"), ("holt_winters_damped", "HW Damped")):
    _cv = f"hw_cv_{len(HW_FORMS[_model])}"
    query(f"{_key}_backtest", sql(f"SELECT Series, Model, Fold, {_ROUND4}, CAST(NULL AS VARCHAR) AS error FROM {_cv}", _cv))(
        _candidate({_model: A.RECURSIVE_MODELS[_model]})
    )

# ridge as relations: a row per month and feature, sums for the products, elimination by a recursive statement
_FEATURES = S.SEASON + 2
view(
    "rx",
    f"""SELECT n, t, j, CASE j WHEN 0 THEN CAST(t AS DOUBLE) / n WHEN 1 THEN pow(CAST(t AS DOUBLE) / n, 2)
                             ELSE CASE WHEN t % {S.SEASON} = j - 2 THEN 1.0 ELSE 0.0 END::DOUBLE END AS v
        FROM (SELECT DISTINCT origin AS n FROM hw_train) CROSS JOIN range(0, {N_MONTHS + HORIZON}) AS t(t)
        CROSS JOIN range(0, {_FEATURES}) AS j(j) WHERE t < n + {HORIZON}""",
    "hw_train",
)
view(
    "rc",
    "SELECT x.n, x.t, x.j, x.v - c.c AS v FROM rx x JOIN (SELECT n, j, avg(v) AS c FROM rx WHERE t < n GROUP BY n, j) c USING (n, j)",
    "rx",
)
view("penalties", f"SELECT i AS alpha_no, v AS alpha FROM {_grid(SM.RIDGE_ALPHAS)} a(i, v)")
view(
    "gram",
    """SELECT n, alpha_no, i, list(g ORDER BY j) AS r FROM (
         SELECT a.n, p.alpha_no, a.j AS i, b.j, sum(a.v * b.v) + CASE WHEN a.j <> b.j THEN 0
                WHEN a.j = 0 THEN any_value(p.alpha) / pow(a.n, 2) WHEN a.j = 1 THEN any_value(p.alpha) / pow(a.n, 4)
                ELSE any_value(p.alpha) END AS g
         FROM rc a JOIN rc b ON a.n = b.n AND a.t = b.t CROSS JOIN penalties p WHERE a.t < a.n GROUP BY a.n, p.alpha_no, a.j, b.j)
       GROUP BY n, alpha_no, i""",
    "rc",
    "penalties",
)
view(
    "elimination",
    f"""SELECT n, alpha_no, 1 AS k, list(list_concat(r, list_transform(range(0, {_FEATURES}), lambda c: CASE WHEN c = i THEN 1.0 ELSE 0.0 END::DOUBLE))
                                 ORDER BY i) AS m
        FROM gram GROUP BY n, alpha_no
        UNION ALL
        SELECT n, alpha_no, k + 1, list_transform(m, lambda r, i: CASE WHEN i = k THEN lead_row
                                       ELSE list_transform(r, lambda v, c: v - r[k] * lead_row[c]) END)
        FROM (SELECT *, list_transform(m[k], lambda v: v / m[k][k]) AS lead_row FROM elimination WHERE k <= {_FEATURES})""",
    "gram",
)
view(
    "inv",
    f"""SELECT n, alpha_no, i.i, j.j, m[i.i + 1][{_FEATURES} + j.j + 1] AS v
        FROM elimination CROSS JOIN range(0, {_FEATURES}) AS i(i) CROSS JOIN range(0, {_FEATURES}) AS j(j) WHERE k = {_FEATURES + 1}""",
    "elimination",
)
view(
    "rz",
    """SELECT Series, Fold, n, t, z - avg(z) OVER (PARTITION BY Series, Fold) AS z, avg(z) OVER (PARTITION BY Series, Fold) AS mean
       FROM (SELECT Series, Fold, origin AS n, t.t, ln(1 + y[t.t + 1]) AS z FROM hw_train CROSS JOIN range(0, origin) AS t(t))""",
    "hw_train",
)
view(
    "rw",
    """SELECT Series, Fold, m.n, v.alpha_no, v.i AS j, sum(v.v * m.b) AS w
       FROM (SELECT z.Series, z.Fold, z.n, x.j, sum(x.v * z.z) AS b FROM rz z JOIN rc x ON x.n = z.n AND x.t = z.t GROUP BY ALL) m
       JOIN inv v ON v.n = m.n AND v.j = m.j GROUP BY ALL""",
    "rz",
    "rc",
    "inv",
)
view(
    "leverage",
    """SELECT a.n, v.alpha_no, a.t, sum(a.v * v.v * b.v) AS h FROM inv v JOIN rc a ON a.n = v.n AND a.j = v.i
       JOIN rc b ON b.n = v.n AND b.j = v.j AND b.t = a.t WHERE a.t < a.n GROUP BY ALL""",
    "inv",
    "rc",
)
view(
    "rbest",
    """SELECT Series, Fold, n, alpha_no FROM (
         SELECT f.Series, f.Fold, f.n, f.alpha_no,
                row_number() OVER (PARTITION BY f.Series, f.Fold ORDER BY avg(pow((z.z - f.fit) / (1 - 1.0 / f.n - h.h), 2)), f.alpha_no) AS rn
         FROM (SELECT w.Series, w.Fold, w.n, w.alpha_no, x.t, sum(w.w * x.v) AS fit FROM rw w JOIN rc x ON x.n = w.n AND x.j = w.j GROUP BY ALL) f
         JOIN rz z ON z.Series = f.Series AND z.Fold = f.Fold AND z.t = f.t
         JOIN leverage h ON h.n = f.n AND h.alpha_no = f.alpha_no AND h.t = f.t
         GROUP BY f.Series, f.Fold, f.n, f.alpha_no) WHERE rn = 1""",
    "rw",
    "rz",
    "leverage",
)
view(
    "ridge_errors",
    f"""SELECT r.Series, r.Fold, any_value(a.y) AS actual, greatest(exp(sum(w.w * x.v) + any_value(z.mean)) - 1, 0) AS p
        FROM rbest r JOIN rw w USING (Series, Fold, alpha_no) JOIN rc x ON x.n = r.n AND x.j = w.j AND x.t >= r.n AND x.t < r.n + {b.CV_HORIZON}
        JOIN modelled a ON a.Series = r.Series AND a.pos = x.t JOIN (SELECT DISTINCT Series, Fold, mean FROM rz) z ON z.Series = r.Series AND z.Fold = r.Fold
        WHERE r.Fold > 0 GROUP BY r.Series, r.Fold, x.t""",
    "rbest",
    "rw",
    "rc",
    "rz",
    "modelled",
)
query(
    "ridge_backtest",
    sql(
        """SELECT Series, 'Ridge' AS Model, Fold, round(sqrt(avg(pow(actual - p, 2))), 4) AS RMSE, round(avg(abs(actual - p)), 4) AS MAE,
                  round(avg(abs(actual - p) / ((abs(actual) + abs(p)) / 2 + 1e-10)) * 100, 4) AS sMAPE,
                  round(sum(abs(actual - p)) / (sum(abs(actual)) + 1e-10) * 100, 4) AS WAPE,
                  round(coalesce(avg(CASE WHEN actual <> 0 THEN abs((actual - p) / actual) END) * 100, 0), 4) AS MAPE,
                  CAST(NULL AS VARCHAR) AS error
           FROM ridge_errors GROUP BY Series, Fold""",
        "ridge_errors",
    ),
)(_candidate(A.RIDGE_MODEL))


@query("full_candidate_forecast", sql("SELECT * FROM detail", "detail"))
def full_candidate_forecast(spark, sf):
    """Model choice by the plan's own defaults."""
    return demand(spark, sf).detail


# ---- models that are plugged in, one of which fails -------------------------------------
def _own_drift(history, horizon):
    """The drift benchmark again, as a caller's own function."""
    slope = (history[-1] - history[0]) / (len(history) - 1)
    return history[-1] + slope * np.arange(1, horizon + 1)


def _late(history, horizon):
    """Fails on histories shorter than the last fold's."""
    if len(history) < b.CV_INITIAL + b.CV_STEP:
        raise ValueError(f"needs {b.CV_INITIAL + b.CV_STEP} months, has {len(history)}")
    return np.repeat(history[-1], horizon)


@query(
    "failed_models",
    sql(
        f"""SELECT DISTINCT Series, 'Late' AS Model, 'ValueError: needs {b.CV_INITIAL + b.CV_STEP} months, has {b.CV_INITIAL}' AS Error,
                   CAST(1 AS BIGINT) AS models_left FROM cv""",
        "cv",
    ),
)
def failed_models(spark, sf):
    """A model with a failed fold is reported by its message and left out of the summary."""
    results = demand(spark, sf, py_models={"Own Drift": _own_drift, "Late": _late}).python_cv
    left = B.summarise(results).groupBy("Series").agg(F.count("Model").alias("models_left"))
    return B.failures(results).join(left, "Series")
