"""Monthly series, validation, forecasts, scenarios and overlay."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltgrid import settings as S
from voltgrid.operators import array_models as A
from voltgrid.operators import backtest as B
from voltgrid.operators import forecast as FC
from voltgrid.operators import overlay as O
from voltgrid.operators import quality as Q
from voltgrid.operators import ranking as R
from voltgrid.operators import series as SE
from voltgrid.operators import smoothing as SM
from voltgrid.operators.cleaning import with_ev_flags, with_forecast_bucket
from voltgrid.operators.tables import literal_table


def day(text):
    return dt.date.fromisoformat(text)


@pytest.fixture(scope="module")
def registrations(spark):
    rows = [
        ("2020-01-05", "BEV"),
        ("2020-01-09", "PHEV"),
        ("2020-01-31", None),
        ("2020-03-01", "REEV"),
        ("2020-03-02", "BEV"),
        (None, "BEV"),  # a date that did not parse
        ("2020-03-09", "XEV"),  # not a rechargeable category
    ]
    df = spark.createDataFrame([(day(d) if d else None, c) for d, c in rows], "registration_date date, ev_category string")
    return with_forecast_bucket(with_ev_flags(df))


def test_flags_are_three_valued(registrations):
    by = {r.ev_category: r for r in registrations.dropDuplicates(["ev_category"]).collect()}
    assert by[None].is_bev is None and by[None].is_rechargeable_ev is None
    assert by["XEV"].is_rechargeable_ev is False and by["XEV"].rechargeable_ev_type is None
    assert by["REEV"].bucket == S.OTHER and by["BEV"].bucket == S.BEV


def test_monthly_series(spark, registrations):
    rows = SE.monthly_series(registrations, day("2020-01-01"), day("2020-04-01")).orderBy("month").collect()
    assert [(r.month.month, r[S.BEV], r[S.OTHER], r[S.ALL_CARS], r[S.ELECTRIFIED], r[S.NORMAL_CARS]) for r in rows] == [
        (1, 1, 1, 3, 2, 1),
        (2, 0, 0, 0, 0, 0),
        (3, 1, 1, 3, 2, 1),
        (4, 0, 0, 0, 0, 0),
    ]
    totals = SE.monthly_market_totals(registrations)
    assert totals.where("month IS NULL").first()[S.ALL_CARS] == 1  # kept here, removed by the calendar join
    calendar = SE.month_calendar(spark, day("2020-01-01"), day("2020-04-01"))
    audit = Q.month_coverage(totals, calendar).first()
    assert (audit.months_present, audit.months_missing, audit.is_gap_free) == (2, 2, False)
    assert [r.month.month for r in Q.missing_months(totals, calendar).orderBy("month").collect()] == [2, 4]
    counts = {r.metric: r.value for r in SE.overall_counts(registrations).collect()}
    assert counts["total_records"] == 7 and counts["rechargeable_ev_bev_phev_reev"] == 5
    index = SE.growth_index(SE.monthly_series(registrations, day("2020-01-01"), day("2020-04-01")))
    assert {(r.month.month, r.series): r.growth_index for r in index.collect()}[(3, S.TOTAL)] == 100.0


def naive(h, n):
    return [h[-1]] * n


def seasonal(h, n):
    return naive(h, n) if len(h) < 12 else [h[-(12 - i % 12)] for i in range(n)]


def drift(h, n):
    return naive(h, n) if len(h) < 2 else [h[-1] + (i + 1) * (h[-1] - h[0]) / (len(h) - 1) for i in range(n)]


def history(n, seed=0):
    rng = np.random.default_rng(seed)
    return [float(v) for v in np.round(100 + 2 * np.arange(n) + 20 * np.sin(np.arange(n) / 6 * math.pi) + rng.normal(0, 5, n))]


@pytest.fixture(scope="module")
def hist(spark):
    rows = [("a", history(40)), ("b", [0.0] * 40), ("short", [5.0] * 10), ("one", [7.0])]
    return spark.createDataFrame([(s, h, day("2020-12-01")) for s, h in rows], "Series string, history array<double>, last_month date")


def test_benchmark_models(hist):
    sql = {n: f"{f('history', 14)} AS `{n}`" for n, f in B.SQL_MODELS.items()}
    for r in hist.selectExpr("Series", "history", *sql.values()).collect():
        assert r["Naive"] == naive(r.history, 14)
        assert r["Seasonal Naive"] == seasonal(r.history, 14)
        assert r["Drift"] == pytest.approx(drift(r.history, 14))


def test_backtest_and_metrics(hist):
    rows = B.backtest(hist, initial=20, step=5, horizon=6).collect()
    by = {(r.Series, r.Model, r.Fold): r for r in rows}
    assert {f for s, m, f in by if s == "a"} == {1, 2, 3}  # origins 20, 25, 30
    assert not [k for k in by if k[0] in ("short", "one")]
    h = history(40)
    for fold, origin in enumerate((20, 25, 30), start=1):
        actual, p = np.array(h[origin : origin + 6]), np.array(drift(h[:origin], 6))
        r = by[("a", "Drift", fold)]
        assert r.RMSE == pytest.approx(np.sqrt(np.mean((actual - p) ** 2)))
        assert r.MAE == pytest.approx(np.mean(np.abs(actual - p)))
        assert r.sMAPE == pytest.approx(np.mean(np.abs(actual - p) / ((np.abs(actual) + np.abs(p)) / 2 + 1e-10)) * 100)
        assert r.WAPE == pytest.approx(np.sum(np.abs(actual - p)) / (np.sum(np.abs(actual)) + 1e-10) * 100)
        assert r.MAPE == pytest.approx(np.mean(np.abs((actual - p) / actual)) * 100)
    zero = by[("b", "Naive", 1)]
    assert (zero.RMSE, zero.MAPE, zero.WAPE) == (0.0, 0.0, 0.0)  # no non-zero actual: MAPE is zero


def test_python_models_and_failures(hist):
    def broken(h, n):
        raise RuntimeError("no fit")

    out = B.backtest_python(hist.where("Series = 'a'"), {**SM.PY_MODELS, **SM.RIDGE_MODEL, "Broken": broken}, 26, 4, 6)
    rows = out.collect()
    good = {r.Model for r in rows if r.error is None}
    assert good == {"Holt-Winters", "HW Damped", "Ridge"}
    assert B.failures(out).first().Error == "RuntimeError: no fit"
    assert {r.Model for r in B.summarise(out).collect()} == good
    # a clean trend with a season is followed closely
    smooth = np.array([100 + 2 * t + 20 * math.sin(t / 6 * math.pi) for t in range(72)])
    for model in (SM.holt_winters, SM.holt_winters_damped):
        assert np.abs(model(smooth[:60], 12) - smooth[60:]).mean() < 6
    with pytest.raises(ValueError):
        SM.holt_winters(smooth[:20], 12)


def test_ridge_matches_direct_leave_one_out():
    y = np.array(history(40))
    x = SM._design(0, 40, 12)
    target, best = np.log1p(y), None
    for alpha in SM.RIDGE_ALPHAS:
        errors = []
        for i in range(40):
            keep = np.arange(40) != i
            xm, ym = x[keep].mean(0), target[keep].mean()
            w = np.linalg.solve((x[keep] - xm).T @ (x[keep] - xm) + alpha * np.eye(14), (x[keep] - xm).T @ (target[keep] - ym))
            errors.append((target[i] - ym - (x[i] - xm) @ w) ** 2)
        score = np.mean(errors)
        if best is None or score < best[0]:
            xm, ym = x.mean(0), target.mean()
            w = np.linalg.solve((x - xm).T @ (x - xm) + alpha * np.eye(14), (x - xm).T @ (target - ym))
            best = (score, np.expm1((SM._design(40, 6, 12) - xm) @ w + ym))
    assert SM.ridge(y, 6) == pytest.approx(np.clip(best[1], 0, None), rel=1e-6)


def test_array_models_equal_the_python_ones(spark):
    rng = np.random.default_rng(5)
    long = [[float(max(0, round(90 + t + 25 * math.sin(t / 6 * math.pi) + rng.normal(0, 12)))) for t in range(n)] for n in (24, 31, 48, 79)]
    flat = [[0.0] * 30, [7.0] * 26]  # nothing to learn, many equal grid points
    df = spark.createDataFrame(list(enumerate(long + flat)), "i int, h array<double>")
    for name, python in {**SM.PY_MODELS, **SM.RIDGE_MODEL}.items():
        for i, h, p in df.selectExpr("i", "h", f"{A.MODELS[name]('h', 15)} AS p").collect():
            assert p == pytest.approx(python(np.array(h), 15), rel=1e-9, abs=1e-9), (name, i)


def test_array_models_without_forecast(spark):
    rows = [("none", None), ("empty", []), ("short", [5.0] * 23), ("gap", [5.0] * 30 + [None] + [5.0] * 5)]
    df = spark.createDataFrame(rows, "Series string, history array<double>")
    for model in A.RECURSIVE_MODELS.values():
        assert all(r.p is None for r in df.selectExpr(f"{model('history', 4)} AS p").collect())
    ridge = {r.Series: r.p for r in df.selectExpr("Series", f"{A.ridge('history', 2)} AS p").collect()}
    assert [ridge[s] for s in ("none", "empty", "gap")] == [None] * 3
    assert ridge["short"] == pytest.approx([5.0, 5.0])
    # folds that are too short leave the model out of the choice; alone it falls back
    short = spark.createDataFrame([("s", [float(v) for v in range(1, 23)])], "Series string, history array<double>")
    results = B.backtest(short, A.CANDIDATES, initial=14, step=4, horizon=4)
    assert {r.Model for r in results.where("RMSE IS NULL").collect()} == set(A.RECURSIVE_MODELS)
    assert [r.Model for r in B.summarise(results).collect()] == ["Seasonal Naive"]
    planned = short.selectExpr("Series", "history", "'Holt-Winters' AS Model")
    assert FC.point_forecasts(planned, 3).first().predicted == [11.0, 12.0, 13.0]


def test_inverse_by_elimination(spark):
    m = np.array([[4.0, 1.0, 0.5], [1.0, 3.0, 0.2], [0.5, 0.2, 5.0]])
    found = spark.createDataFrame([(m.tolist(),)], "m array<array<double>>").selectExpr(f"{A.inverse('m', 3)} AS v").first().v
    assert np.allclose(np.array(found) @ m, np.eye(3))


def summary_table(spark, rows):
    return literal_table(spark, ["Series", "Model", "RMSE", "MAE", "sMAPE"], rows)


def test_model_selection(spark):
    rows = [
        ("close", "A", 100.0, 1.0, 1.0), ("close", "B", 105.0, 1.0, 1.0), ("close", "C", 300.0, 1.0, 1.0),
        ("far", "A", 100.0, 1.0, 1.0), ("far", "B", 105.1, 1.0, 1.0),
        ("zero", "A", 0.0, 0.0, 0.0), ("zero", "B", 0.0, 0.0, 0.0),
        ("alone", "A", 3.0, 1.0, 1.0),
    ]
    plans = {r.Series: r for r in B.select_models(summary_table(spark, rows)).collect()}
    assert plans["close"].models == ["A", "B"]
    assert plans["close"].weights == pytest.approx([105 / 205, 100 / 205])
    assert [plans[s].plan_type for s in ("far", "zero", "alone")] == ["single"] * 3
    performance = {r.Series: r for r in B.model_performance(B.select_models(summary_table(spark, rows)), summary_table(spark, rows)).collect()}
    assert performance["close"].CV_RMSE is None and performance["close"].note == "Weighted Avg Used"
    assert performance["far"].CV_RMSE == 100.0


@pytest.fixture(scope="module")
def detail(spark):
    h = [float(v) for v in range(1, 25)]
    rows = [(s, h if s != S.ELECTRIFIED else [v * 0.5 for v in h]) for s in S.MODELLED_SERIES]
    hist = spark.createDataFrame([(s, v, day("2026-03-01")) for s, v in rows], "Series string, history array<double>, last_month date")
    plan = spark.createDataFrame(
        [(S.BEV, "ensemble", ["Naive", "Drift"], [0.5, 0.5]), (S.ALL_CARS, "single", ["Unknown"], [1.0]),
         (S.OTHER, "single", ["Naive"], [1.0])],
        "Series string, plan_type string, models array<string>, weights array<double>",
    )
    first = literal_table(spark, ["Series", "Model", "RMSE"], [(S.BEV, "Naive", 4.0)])
    second = literal_table(spark, ["Series", "Model", "RMSE"], [(S.BEV, "Naive", 9.0), (S.BEV, "Drift", 2.0)])
    return FC.forecast_detail(hist, plan, FC.sigma_table(first, second), 21)


def test_point_forecast_bands_and_fallbacks(detail):
    rows = {(r.vehicle_type, r.month): r for r in detail.collect()}
    r = rows[(S.BEV, day("2026-04-01"))]
    # naive 24, drift 25, mean 24.5; sigma (4 + 2) / 2 = 3: candidates win over benchmarks
    assert r.point_forecast == 24  # tie goes to the even number
    assert r.upper95 == round(24.5 + 1.959963985 * 3)
    assert r.lower_scenario == round(24.5 - 0.385320466 * 3)
    assert r.selected_model == "Ensemble (Naive, Drift)"
    unknown = rows[(S.ALL_CARS, day("2026-04-01"))]
    assert unknown.point_forecast == 13 and unknown.lower95 == unknown.upper95 == 13  # seasonal naive, sigma 0
    assert rows[(S.ELECTRIFIED, day("2027-12-01"))].selected_model == "Seasonal Naive"  # no plan
    for r in rows.values():
        assert 0 <= r.lower95 <= r.lower_scenario <= r.point_forecast <= r.upper_scenario <= r.upper95


def test_derived_series_scenarios_and_years(spark, detail):
    whole = FC.with_derived(detail)
    rows = {(r.vehicle_type, r.month): r for r in whole.collect()}
    m = day("2026-06-01")
    assert rows[(S.TOTAL, m)].upper95 == rows[(S.BEV, m)].upper95 + rows[(S.OTHER, m)].upper95
    cars, total, part = rows[(S.NORMAL_CARS, m)], rows[(S.ALL_CARS, m)], rows[(S.ELECTRIFIED, m)]
    assert cars.lower_scenario == max(total.lower_scenario - part.upper_scenario, 0)
    assert cars.upper95 == total.upper95 - part.lower95
    long = FC.forecast_long(whole)
    assert {r.scenario for r in long.collect()} == set(S.SCENARIOS)
    observed = literal_table(spark, ["year", "vehicle_type", "observed_total"], [(2026, S.BEV, 1000), (2027, S.BEV, 5)])
    annual = FC.annual_summary(long, observed.where("year = 2026"))
    got = {(r.year, r.vehicle_type, r.scenario): r.forecast_total for r in annual.collect()}
    plain = sum(rows[(S.BEV, day(f"2026-{k:02d}-01"))].lower_scenario for k in range(4, 13))
    assert got[(2026, S.BEV, "pessimistic")] == 1000 + plain
    planning = FC.planning_summary(annual, 2027)
    assert [r.scenario for r in planning.collect()] == ["pessimistic", "normal", "optimistic"]
    assert FC.planning_number(planning).first().planning_number == got_demand(got)
    with pytest.raises(Exception, match="no planning row"):
        FC.planning_number(FC.planning_summary(annual, 1999)).collect()
    with pytest.raises(ValueError):
        FC.planning_summary(annual.drop("scenario"), 2027)
    weights = FC.weight_sensitivity(planning, 2027, weights=(0.25, 0.35, 0.351, 0.5)).collect()
    assert sorted(r.charging_weight for r in weights) == [0.25, 0.35, 0.5]


def got_demand(got):
    return int(math.floor(got[(2027, S.BEV, "normal")] + 0.35 * got[(2027, S.OTHER, "normal")] + 0.5))


def annual_rows(spark, total):
    rows = [(y, S.TOTAL, s, total) for y in range(2026, 2032) for s in S.SCENARIOS]
    return literal_table(spark, ["year", "vehicle_type", "scenario", "forecast_total"], rows)


def test_drivers_and_overlay(spark):
    drivers = O.driver_assumptions(annual_rows(spark, 600_000), 2026, 2031)
    rows = {(r.year, r.scenario): r for r in drivers.collect()}
    assert len(rows) == 18
    r = rows[(2027, "pessimistic")]
    assert r.gdp_growth == pytest.approx(1.3) and r.battery_pack_usd_per_kwh == 104.0
    saturation = min(max(1 - 0.08 * (600_000 / 750_000) ** 1.6, 0.9), 1.0)
    assert r.saturation_factor == pytest.approx(saturation)
    raw = 1 + 0.015 * (1.3 - 2) - 0.008 * (2.6 - 2) - 0.015 * (2.6 - 2) + 0.0015 * (97 - 100) + 0.08 * (0.95 - 1) + 0.1 * (0.95 - 1)
    assert r.macro_adjustment_multiplier == pytest.approx(max(min(max(raw, 0.9), 1.1) * saturation, 0.85))
    # unknown yearly total: no saturation
    none = O.driver_assumptions(annual_rows(spark, 1).where("year = 1900"), 2026, 2026).first()
    assert none.saturation_factor == 1.0
    long = literal_table(
        spark, ["month", "vehicle_type", "scenario", "forecast"],
        [("2027-05-01", S.BEV, "pessimistic", 1000), ("2027-05-01", S.OTHER, "pessimistic", 500), ("2040-01-01", S.BEV, "normal", 7)],
    ).withColumn("month", F.col("month").cast("date"))
    out = {(r.year, r.vehicle_type): r for r in O.overlay_monthly(long, drivers).collect()}
    bev = out[(2027, S.BEV)]
    battery = 1 + 0.20 * 0.85 * (108 - 104) / 108
    assert bev.battery_adjustment_multiplier == pytest.approx(battery)
    assert bev.adjusted_forecast == round(1000 * r.macro_adjustment_multiplier * battery)
    assert out[(2040, S.BEV)].adjusted_forecast is None  # no driver for that year
    total = out[(2027, S.TOTAL)]
    assert total.adjusted_forecast == bev.adjusted_forecast + out[(2027, S.OTHER)].adjusted_forecast
    assert total.macro_adjustment_multiplier is None
    assert total.adjustment_multiplier == pytest.approx(total.adjusted_forecast / 1500)


def test_reported_multiplier_is_bounded_but_applied_is_not(spark):
    drivers = literal_table(
        spark, ["year", "scenario", "battery_pack_usd_per_kwh", "macro_adjustment_multiplier"], [(2027, "optimistic", 50.0, 1.15)]
    )
    long = literal_table(spark, ["month", "vehicle_type", "scenario", "forecast"], [("2027-01-01", S.BEV, "optimistic", 1000)])
    r = O.overlay_monthly(long.withColumn("month", F.col("month").cast("date")), drivers).where(f"vehicle_type = '{S.BEV}'").first()
    assert r.battery_adjustment_multiplier == 1.08
    assert r.adjustment_multiplier == 1.15
    assert r.adjusted_forecast == round(1000 * 1.15 * 1.08)


def test_market_share_keeps_forecast_only_years(spark):
    wide = literal_table(spark, ["month", S.BEV, S.OTHER, S.TOTAL, S.ALL_CARS], [("2025-01-01", 1, 1, 2, 10), ("2026-01-01", 2, 2, 4, 0)])
    wide = wide.withColumn("month", F.col("month").cast("date"))
    annual = literal_table(
        spark, ["year", "vehicle_type", "scenario", "forecast_total"],
        [(y, k, "normal", v) for y in (2026, 2027) for k, v in ((S.BEV, 5), (S.OTHER, 5), (S.TOTAL, 10), (S.ALL_CARS, 0))],
    )
    rows = {r.year: r for r in FC.market_share(wide, annual, 2026).collect()}
    assert sorted(rows) == [2025, 2026, 2027]
    assert rows[2025][f"{S.TOTAL}_share_pct"] == 20.0
    assert rows[2027].months_in_year is None and rows[2027][f"{S.BEV}_share_pct"] == 500.0  # base of at least one


def test_quality(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    df.write.parquet(str(tmp_path / "t"))
    gate = Q.dataset_gate(spark, str(tmp_path / "t"), ["k", "z"]).first()
    assert (gate.is_valid, gate.reason, gate.missing_columns) == (False, "missing_columns", "z")
    assert Q.dataset_gate(spark, str(tmp_path / "none"), ["k"]).first().reason == "file_missing"
    assert Q.gate_report(df.limit(0), ["k"]).first().reason == "empty_table"
    assert Q.gate_report(df, ["k"]).first().row_count == 2
    assert {r.column: r.null_count for r in Q.null_counts(df).collect()} == {"k": 0, "v": 1}
    assert [(r.column, r.is_numeric) for r in Q.schema_listing(df).collect()] == [("k", True), ("v", False)]
    with pytest.raises(ValueError, match="z"):
        Q.require_columns(df, ["z"])
    with pytest.raises(Exception, match="bad row"):
        Q.assert_no_rows(df, F.col("k") == 2, "bad row").collect()
    assert Q.assert_no_rows(df, F.col("k") == 9, "bad row").count() == 2


def test_ranking(spark):
    df = spark.range(1, 1001).select("id", (F.col("id") % 10).alias("g"))
    assert R.exact_quantile(df, "id", 0.7).first().threshold == pytest.approx(np.quantile(np.arange(1, 1001), 0.7))
    assert R.above_quantile(df, "g", 0.3).count() == 300  # threshold 6.3
    numbered = R.number_rows(df.orderBy(F.rand(3)), ["id"]).collect()
    assert {r.id: r.row_id for r in numbered} == {i: i for i in range(1, 1001)}
    labels = R.with_labels(df.where("id <= 12"), ["id"], "IBE", "label").orderBy("id").collect()
    assert [labels[0].label, labels[11].label] == ["IBE_001", "IBE_012"]
    one, two = (sorted(r.id for r in R.seeded_sample(df.orderBy(F.rand(s)), ["id"], 50).collect()) for s in (1, 2))
    assert one == two and len(set(one)) == 50
    assert [r.id for r in R.tail(df, 3, ["id"]).collect()] == [998, 999, 1000]
    best = R.first_per_group(df, ["g"], [-F.col("id")]).collect()
    assert sorted(r.id for r in best) == list(range(991, 1001))
    assert [r.n for r in R.value_counts(df, "g", k=2).collect()] == [100, 100]
    top = R.ratio_to_max(R.top_k(df, 2, "id", ["g"]), "id", "share").orderBy("id").collect()
    assert [r.share for r in top] == [0.999, 1.0]
