"""Flows and the network chain on a small hand-made map."""

import pytest
from pyspark.sql import functions as F

from voltgrid import settings as S
from voltgrid.functions import geodesy as G
from voltgrid.operators import flows as FL
from voltgrid.operators import network as N
from voltgrid.operators.tables import literal_table, provinces
from voltgrid.plans.network import NetworkPlan


def line(*points):
    return [{"x": float(x), "y": float(y)} for x, y in points]


@pytest.fixture(scope="module")
def roads(spark):
    rows = [
        (1, "Major Highway", "AP-1", line((0, 0), (100_000, 0), (180_000, 0))),  # 180 km: only its ends
        (2, "Secondary Highway", "N2", line((0, 50_000), (352_000, 50_000))),  # 352 km: three points
        (3, "Road", "A3", line((0, 0), (10_000, 0))),  # wrong type
        (4, "Major Highway", "M-30", line((0, 0), (10_000, 0))),  # wrong prefix
        (5, "Major Highway", None, line((0, 0), (10_000, 0))),  # no label
        (6, "Major Highway", "E6", line((0, 400_000), (0, 500_000))),  # runs through the city
    ]
    return spark.createDataFrame(rows, "road_id long, type string, label string, vertices array<struct<x:double,y:double>>")


def box(spark, x0, y0, x1, y1):
    ring = ", ".join(f"named_struct('x', {float(x)}D, 'y', {float(y)}D)" for x, y in ((x0, y0), (x1, y0), (x1, y1), (x0, y1)))
    return spark.sql(f"SELECT {G.ring_edges(f'array(array({ring}))')} AS edges")


@pytest.fixture(scope="module")
def plan(spark, roads):
    sites = literal_table(
        spark, ["site_id", "x", "y", "n_connectors"],
        [(1, 100.0, 499.0, 0), (2, 100.0, 501.0, 2), (3, 5_000.0, 10.0, 2), (4, 150_000.0, -300.0, 4), (5, 9_000.0, 50_100.0, None)],
    ).selectExpr("cast(site_id AS long) site_id", "x", "y", "cast(n_connectors AS int) n_connectors")
    substations = literal_table(
        spark, ["substation_id", "x", "y", "capacity_available_mw", "grid_operator"],
        [(1, 0.0, 0.0, 0.8, "Viesgo"), (2, 351_000.0, 50_000.0, None, "Endesa e-distribución"), (3, 352_000.0, 0.0, 0.5, "Iberdrola i-DE")],
    )
    return NetworkPlan(
        sites, roads, box(spark, -20_000, 420_000, 20_000, 440_000), box(spark, -1e6, -1e6, 400_000, 1e6), substations, F.lit(2.0)
    )


def test_roads_and_stations(plan):
    assert sorted(r.road_id for r in plan.roads.collect()) == [1, 2]
    assert sorted(r.site_id for r in plan.stations.collect()) == [1, 3, 4, 5]


def test_pressure_and_expansion(plan):
    rows = {r.site_id: r for r in N.station_pressure(N.snap_to_road(plan.stations, plan.roads), plan.growth).collect()}
    assert (rows[1].pressure_score, rows[3].pressure_score, rows[4].pressure_score) == (6.0, 3.0, 1.5)
    assert (rows[5].pressure_score, rows[5].route_segment, rows[1].route_segment) == (3.0, "N-2", "AP-1")
    # 70 % of {1.5, 3, 3, 6}: position 2.1 between 3 and 6
    assert [r.site_id for r in plan.expand.collect()] == [1]


def test_candidates(plan):
    got = sorted((r.road_id, r.step, round(r.x), round(r.y), r.road_weight) for r in N.road_candidates(plan.roads).collect())
    assert got == [
        (1, 0, 0, 0, 3.0), (1, 1, 180_000, 0, 3.0),
        (2, 0, 0, 50_000, 1.5), (2, 1, 176_000, 50_000, 1.5), (2, 2, 352_000, 50_000, 1.5),
    ]


def test_fill_and_thinning(plan):
    # only the far end of road 2 lies more than 100 km from every station
    assert [(r.road_id, r.step) for r in plan.fill.collect()] == [(2, 2)]
    assert [(r.road_id, r.step) for r in plan.thinned.collect()] == [(2, 2)]


def test_result_tables(spark, plan):
    stations = {r.location_id: r for r in plan.proposed_stations.collect()}
    assert (stations["IBE_001"].station_type, stations["IBE_001"].grid_status) == ("EXPAND", "Sufficient")
    second = stations["IBE_002"]
    assert (second.station_type, second.pressure_score, second.n_chargers_proposed) == ("FILL", 0.0, 4)
    assert second.grid_status == "Moderate"  # the nearest known capacity, not the nearest substation
    friction = plan.friction_points.collect()
    assert [(r.bottleneck_id, r.distributor_network, r.estimated_demand_kw) for r in friction] == [("FRIC_001", "Endesa", 600)]
    card = plan.scorecard(literal_table(spark, ["n"], [(139_000,)])).first()
    assert tuple(card) == (2, 4, 1, 139_000)
    assert N.priority_stations(plan.proposed).count() == 1


def test_without_stations_every_candidate_stays(spark, plan):
    none = plan.stations.limit(0)
    kept = N.fill_candidates(N.road_candidates(plan.roads), plan.country, plan.urban, none)
    assert kept.count() == 5


def test_duplicate_places_keep_the_first(spark):
    rows = [(1.0, 1.0, 1, -3.0, 7, 0), (1.0, 1.0, 0, 0.0, 9, 0), (2.0, 1.0, 1, -1.5, 1, 0)]
    df = literal_table(spark, ["x", "y", *N.PROPOSAL_ORDER], rows)
    assert sorted(r.source_id for r in N.unique_places(df).collect()) == [1, 9]


def test_province_flows(spark):
    od = literal_table(
        spark, ["origin_zone", "destination_zone", "trips"],
        [("01001", "28001", 5.0), ("01002", "28009", 7.0), ("01001", "01009", 99.0), (None, "28001", 3.0), ("99001", "01001", 50.0)],
    )
    flows = FL.province_flows(od)
    assert {(r.origin, r.destination): r.trips for r in flows.collect()} == {("01", "28"): 12.0, ("99", "01"): 50.0}
    top = FL.top_flows(flows, provinces(spark)).collect()
    assert [(r.origin_name, r.destination_name, r.ratio) for r in top] == [("Araba/Álava", "Madrid", 0.24)]
    assert [(r.code, r.ratio) for r in FL.outbound_trips(flows, provinces(spark)).collect()] == [("01", 1.0)]
    assert provinces(spark, "plate").count() == 50


def test_registrations_by_plate_letters(spark):
    df = literal_table(spark, ["province_code", "propulsion_code"], [("M", "3"), ("M", "H"), ("B", "2"), ("??", "3"), (None, "3")])
    rows = FL.registrations_by_province(df, provinces(spark, "plate")).collect()
    assert [(r.code, r.total_ev, r.pure_bev, r.phev, r.ratio) for r in rows] == [("M", 2, 1, 1, 1.0), ("B", 1, 0, 0, 0.5)]


def test_readiness_density_and_connectors(spark):
    subs = literal_table(
        spark, ["substation_id", "grid_operator", "capacity_available_mw", "capacity_occupied_mw"],
        [(1, "a", 0.8, 0.2), (2, "a", 0.1, 0.1), (3, "b", None, 0.1)],
    )
    share = {r.grid_operator: r.ready_share for r in FL.readiness_share(FL.substation_readiness(subs)).collect()}
    assert share == {"a": 0.5, "b": 0.0, "ALL": pytest.approx(1 / 3)}
    points = literal_table(spark, ["latitude", "longitude"], [(42.225, -8.720), (42.26, -8.72), (42.27, -8.72)])
    assert FL.points_in_radius(points).count() == 2
    assert FL.point_density(points, "longitude", "latitude", 0.05).count() == 2
    sites = spark.sql("SELECT 's' AS site_id, array(50000D, 150000D) AS powers, array('b', 'a', 'b') AS types")
    r = FL.connector_summary(sites).first()
    assert (r.n_connectors, r.max_power_kw, r.connector_types) == (2, 150.0, "a, b")
    assert S.DEMAND_KW == 600
