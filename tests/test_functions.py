"""Scalar functions, including the semantic traps, against hand-computed values."""

import pytest
from pyspark.sql import functions as F

from voltgrid import settings as S
from voltgrid.functions import dates, geodesy, numeric, scoring, text
from voltgrid.operators.cleaning import unique_headers


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")


def apply(spark, values, function, kind="string"):
    df = column(spark, values, kind).select("i", function(F.col("c")).alias("r"))
    return [r.r for r in df.orderBy("i").collect()]


def test_numbers(spark):
    values = ["1.234,5", "12,5", " 7 ", "x", "", None]
    assert apply(spark, values, text.spanish_number) == [1234.5, 12.5, 7.0, None, None, None]
    # decimal comma only: the grouping dot stays and breaks the number
    assert apply(spark, values, text.decimal_comma_number) == [None, 12.5, 7.0, None, None, None]
    assert apply(spark, ["*12", "1*2*3", "5", "**1"], text.starred_number) == [12.0, None, 5.0, None]


def test_text(spark):
    assert apply(spark, ["  a ", "  ", None], text.blank_to_null) == ["a", None, None]
    assert apply(spark, ["0101", "28", None], text.code_prefix) == ["01", "28", None]
    labels = {"3": "Electric"}
    assert apply(spark, ["3", "9", None], lambda c: text.label_of(c, labels, "Other")) == ["Electric", "Other", "Other"]
    assert apply(spark, ["3", "9", None], lambda c: text.relabel(c, labels)) == ["Electric", "9", None]
    cities = ["Parking Madrid", "MÁLAGA Centro", "malaga", None]
    assert apply(spark, cities, lambda c: text.mentions_any(c, S.EXCLUDED_CITIES)) == [True, False, True, False]
    prefixes = ["ap-7", "A7", "e70", "N340", "M30", None]
    assert apply(spark, prefixes, lambda c: text.starts_with_any(c, list(S.ROAD_WEIGHTS))) == [True] * 4 + [False] * 2
    sizes = [0, 1536, 5 * 1024**2, 3 * 1024**4, None]
    assert apply(spark, sizes, text.byte_size_text, "long") == ["0.00 B", "1.50 KB", "5.00 MB", "3.00 TB", "0.00 B"]


def test_dates(spark):
    got = apply(spark, ["31122020", "31022024", "", None], lambda c: dates.parse_date(c, "ddMMyyyy").cast("string"))
    assert got == ["2020-12-31", None, None, None]
    import datetime as dt

    assert dates.months_between(dt.date(2026, 3, 1), dt.date(2031, 12, 1)) == 69


def test_numeric(spark):
    assert apply(spark, [-1.0, 0.5, 9.0, None], lambda c: numeric.clip(c, 0.0, 1.0), "double") == [0.0, 0.5, 1.0, None]
    assert apply(spark, [0.5, 1.5, 2.5, 2.6], numeric.half_even, "double") == [0.0, 2.0, 2.0, 3.0]
    empty = spark.createDataFrame([], "v double")
    assert empty.agg(numeric.total(F.col("v")).alias("t")).first().t == 0


def test_headers():
    assert unique_headers(["Provincia", "x", "Provincia", "Provincia"]) == ["Provincia", "x", "Provincia_1", "Provincia_2"]


def test_road_scores(spark):
    labels = ["AP-9", "A7", "e70", "N340", "ALBACETE", "M30", " ap7 ", None]
    weights = [3.0, 2.5, 2.0, 1.5, 2.5]
    assert apply(spark, labels, lambda c: scoring.road_weight(c, 1.0)) == [*weights, 1.0, 3.0, 1.0]
    assert apply(spark, labels, lambda c: scoring.road_weight(c, 1.5)) == [*weights, 1.5, 3.0, 1.5]
    assert apply(spark, labels, scoring.road_segment_label) == [
        "AP-9", "A-7", "E-70", "N-340", "ALBACETE", "M30", "AP-7", "N-Unknown",
    ]
    # the stand-in for a missing label starts with N and weighs like an N road
    assert apply(spark, ["N-Unknown"], lambda c: scoring.road_weight(c, 1.0)) == [1.5]


def test_grid_scores(spark):
    assert apply(spark, [0.72, 0.7199, 0.48, 0.4, -0.1, None], scoring.grid_status, "double") == [
        "Sufficient", "Moderate", "Moderate", "Congested", "Congested", "Congested",
    ]
    rows = [(1.0, 1.0), (0.0, 0.0), (None, 0.5), (-1.0, 0.5)]
    df = spark.createDataFrame(rows, "a double, o double")
    assert [r.u for r in df.select(scoring.utilisation(F.col("a"), F.col("o")).alias("u")).collect()] == [0.5, 0.0, 1.0, 0.0]
    df = spark.createDataFrame([(0,), (2,), (None,)], "n int")
    got = df.select(scoring.pressure_score(F.lit(1.2345), F.lit(3.0), F.col("n")).alias("p")).collect()
    assert [r.p for r in got] == [3.704, 1.852, 3.704]
    df = spark.createDataFrame([(100, 10, 974028.0)], "b long, o long, p double")
    row = df.select(
        scoring.charging_demand(F.col("b"), F.col("o")).alias("d"), scoring.growth_multiplier(F.col("p")).alias("g")
    ).first()
    assert (row.d, row.g) == (104, 2.0)  # 103.5 rounds away from zero


def test_haversine(spark):
    df = spark.createDataFrame([(40.0, -3.0, 41.0, -3.0)], "a double, b double, c double, d double")
    got = df.selectExpr(f"{geodesy.haversine_m('a', 'b', 'c', 'd')} AS m").first().m
    assert got == pytest.approx(111_195.08, abs=1)


def test_line_box(spark):
    v = [{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 4.0}]
    df = spark.createDataFrame([(v,)], "v array<struct<x:double,y:double>>")
    row = df.selectExpr(
        f"{geodesy.line_meets_box('v', (4.0, 9.0), (0.0, 1.0))} AS a",
        f"{geodesy.line_meets_box('v', (4.0, 9.0), (0.0, 4.0))} AS b",
        f"{geodesy.line_meets_box('v', (1.0, 2.0), (0.0, 9.0))} AS c",
        f"{geodesy.line_meets_box('v', (4.1, 9.0), (0.0, 9.0))} AS d",
        f"{geodesy.line_meets_box('v', (1.0, 2.0), (0.0, 1.0))} AS e",
    ).first()
    # extents overlap in all but d; the line itself misses the first box and touches a corner of the last
    assert tuple(row) == (False, True, True, False, True)
    bent = [{"x": 0.0, "y": 0.0}, {"x": 10.0, "y": 0.0}, {"x": 10.0, "y": 10.0}]
    rows = spark.createDataFrame([(bent,), ([{"x": 5.0, "y": 5.0}] * 2,)], df.schema)
    got = [r.a for r in rows.selectExpr(f"{geodesy.line_meets_box('v', (2.0, 6.0), (2.0, 6.0))} AS a").collect()]
    assert got == [False, True]
