"""Exact quantiles against NumPy, with intervals small enough for several rounds."""

import random

import numpy as np
import pytest

from voltgrid.operators.quantiles import exact_quantiles
from voltgrid.operators.ranking import above_quantile, exact_quantile

SHARES = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)


def _values(kind):
    rng = random.Random(kind)
    if kind == "even":
        return [rng.random() for _ in range(3_000)]
    if kind == "wide":
        return [rng.choice([-1, 1]) * 10.0 ** rng.uniform(-200, 200) for _ in range(3_000)]
    if kind == "ties":
        return [float(rng.choice([0, 0, 0, 1, 5, rng.randrange(400)])) for _ in range(5_000)]
    return [7.0] * 50


@pytest.mark.parametrize("kind", ["even", "wide", "ties", "one"])
def test_several_rounds_of_selection(spark, kind):
    values = _values(kind)
    rows = [(v, None if i % 3 else -v) for i, v in enumerate(values)] + [(None, None), (float("nan"), None)]
    df = spark.createDataFrame(rows, "a double, b double").selectExpr("a", "b", "cast(NULL AS double) AS c")
    got = exact_quantiles(df, ["a", "b", "c"], SHARES, cut=8, few=10)
    assert got["a"] == pytest.approx(np.quantile(values, SHARES).tolist(), rel=1e-12)
    assert got["b"] == pytest.approx(np.quantile([-v for v in values[::3]], SHARES).tolist(), rel=1e-12)
    assert got["c"] == [None] * len(SHARES)


def test_threshold_of_the_top_share(spark):
    df = spark.createDataFrame([(i, float(i % 40)) for i in range(400)], "id long, v double")
    assert exact_quantile(df, "v", 0.3).first().threshold == pytest.approx(np.quantile([i % 40 for i in range(400)], 0.3))
    assert {r.v for r in above_quantile(df, "v", 0.05).collect()} == {38.0, 39.0}
    assert above_quantile(df.limit(0), "v").isEmpty() and exact_quantile(df.limit(0), "v", 0.5).first().threshold is None


def test_plans_hold_no_whole_column(spark):
    df = spark.createDataFrame([(float(i),) for i in range(50)], "v double")
    assert "percentile(" not in above_quantile(df, "v")._jdf.queryExecution().toString()
