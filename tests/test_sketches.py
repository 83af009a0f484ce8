"""Profiles merged from stored days, gate answers, archives as rows."""

import io
import zipfile

import pytest
from pyspark.sql import functions as F

from voltgrid.operators import quality as Q
from voltgrid.operators import sketches as SK
from voltgrid.sources import fixed_width


@pytest.fixture(scope="module")
def flows(spark):
    # routes come back on other days, so days do not simply add up
    rows = spark.range(60_000).selectExpr(
        "date_add(DATE '2024-01-30', cast(id % 4 AS int)) AS date",
        "concat('z', id % 90) AS origin_zone",
        "if(id % 50 = 0, NULL, concat('z', id % 70)) AS destination_zone",
        "cast(id % 21001 AS string) AS route_id",
        "if(id % 10 = 0, NULL, cast(id % 7 AS double)) AS distance_km",
        "2D AS trips",
    )
    return rows.cache()


def test_merged_days_equal_the_whole_within_the_error(flows):
    days = SK.flow_sketches(flows)
    whole = SK.merge_sketches(days, []).first()
    exact = flows.agg(
        F.countDistinct("route_id").alias("r"), F.countDistinct("origin_zone", "destination_zone").alias("p"),
        F.avg("distance_km").alias("km"),
    ).first()
    assert (whole.n_rows, whole.total_trips) == (60_000, 120_000.0)
    assert whole.avg_distance_km == pytest.approx(exact.km)
    assert abs(whole.unique_routes - exact.r) <= 4 * SK.STANDARD_ERROR * exact.r
    assert abs(whole.unique_pairs - exact.p) <= 4 * SK.STANDARD_ERROR * exact.p
    # merging twice gives what merging once gives
    months = SK.flow_sketches(flows.withColumn("month", F.trunc("date", "MM")), ["month"])
    direct = {r.month: r for r in SK.merge_sketches(months, ["month"]).collect()}
    for r in SK.merge_sketches(days.withColumn("month", F.trunc("date", "MM")), ["month"]).collect():
        assert (r.n_rows, r.total_trips) == (direct[r.month].n_rows, direct[r.month].total_trips)
        assert r.unique_routes == pytest.approx(direct[r.month].unique_routes, rel=4 * SK.STANDARD_ERROR)


def test_sketches_of_nothing(flows):
    assert SK.merge_sketches(SK.flow_sketches(flows.where("false")), ["date"]).collect() == []
    blank = flows.limit(3).withColumns({c: F.lit(None).cast("string") for c in ("origin_zone", "destination_zone", "route_id")})
    row = SK.merge_sketches(SK.flow_sketches(blank.withColumns({"trips": F.lit(None).cast("double"), "distance_km": F.lit(None).cast("double")})), []).first()
    assert (row.n_rows, row.total_trips, row.avg_distance_km, row.unique_routes, row.unique_pairs) == (3, 0.0, None, 0, 0)


def test_gate_reports_files_that_are_no_parquet(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part-0.parquet").write_text("not a table")
    row = Q.dataset_gate(spark, str(tmp_path / "t"), ["a"]).first()
    assert (row.is_valid, row.reason.split(":")[0], row.row_count) == (False, "read_failed", 0)


def test_archives_given_as_rows(spark):
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("export.txt", "año\r\nb".encode("latin-1"))
        archive.writestr("notes.txt", b"second member")
    empty = io.BytesIO()
    with zipfile.ZipFile(empty, "w") as archive:
        archive.writestr("export.txt", b"")
    rows = [("/x/export_202403.zip", packed.getvalue()), ("/x/export_202404.zip", empty.getvalue())]
    lines = fixed_width.unzip_lines(spark.createDataFrame(rows, "path string, content binary"))
    found = fixed_width.with_file_month(lines).select("value", "year", "month").collect()
    assert sorted(map(tuple, found)) == [("año", 2024, 3), ("b", 2024, 3)]
