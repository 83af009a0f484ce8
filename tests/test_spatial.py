"""Spatial joins against brute force on small fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from voltgrid.functions import geodesy as G
from voltgrid.operators import spatial
from voltgrid.operators.thinning import greedy_thinning


def seg_dist(px, py, x1, y1, x2, y2):
    dx, dy = x2 - x1, y2 - y1
    l2 = dx * dx + dy * dy
    t = 0 if l2 == 0 else max(0, min(1, ((px - x1) * dx + (py - y1) * dy) / l2))
    return math.hypot(px - x1 - t * dx, py - y1 - t * dy)


def make_points(n, seed, span=800_000):
    rng = random.Random(seed)
    rows = [(i, float(rng.randrange(span)), float(4_000_000 + rng.randrange(span))) for i in range(n)]
    # a crowded spot and repeated positions
    rows += [(n + i, 250_000.0 + i % 7, 4_300_000.0) for i in range(n // 2)]
    return rows


@pytest.fixture(scope="module")
def points(spark):
    rows = make_points(150, 1)
    return rows, spark.createDataFrame(rows, "id long, x double, y double")


@pytest.fixture(scope="module")
def segments(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        x, y = rng.randrange(800_000), 4_000_000 + rng.randrange(800_000)
        a, length = rng.random() * 7, rng.randrange(0, 300_000)
        rows.append((i, float(x), float(y), x + length * math.cos(a), y + length * math.sin(a)))
    rows.append((60, *rows[3][1:]))  # same shape, higher id
    return rows, spark.createDataFrame(rows, "road long, x1 double, y1 double, x2 double, y2 double")


def test_nearest_point(spark, points):
    rows, df = points
    items = make_points(40, 3)
    right = spark.createDataFrame(items, "item long, x double, y double")
    got = {r.id: r for r in spatial.nearest(df, right, ["item"], "item").collect()}
    assert len(got) == len(rows)
    for i, x, y in rows:
        d, item = min((math.hypot(x - a, y - b), k) for k, a, b in items)
        assert got[i].item == item
        assert got[i].distance_m == pytest.approx(d)


def test_nearest_segment(spark, points, segments):
    rows, df = points
    segs, right = segments
    got = {r.id: r for r in spatial.nearest(df, right, ["road"], "road", geometry="segment").collect()}
    for i, x, y in rows:
        d, road = min((seg_dist(x, y, *s[1:]), s[0]) for s in segs)
        assert got[i].road == road
        assert got[i].distance_m == pytest.approx(d)


def test_nearest_without_items_or_position(spark):
    left = spark.createDataFrame([(1, 1.0, 1.0), (2, None, 1.0)], "id long, x double, y double")
    right = spark.createDataFrame([], "item long, x double, y double")
    got = spatial.nearest(left, right, ["item"], "item").orderBy("id").collect()
    assert [(r.id, r.item, r.distance_m) for r in got] == [(1, None, None), (2, None, None)]
    one = spark.createDataFrame([(5, 3.0, 1.0)], "item long, x double, y double")
    got = spatial.nearest(left, one, ["item"], "item").orderBy("id").collect()
    assert [(r.id, r.item, r.distance_m) for r in got] == [(1, 5, 2.0), (2, None, None)]


def test_within_distance_of_lines(spark, points, segments):
    rows, df = points
    segs, right = segments
    got = {r.id for r in spatial.within_distance_of_lines(df, right, 5_000.0).collect()}
    assert got == {i for i, x, y in rows if min(seg_dist(x, y, *s[1:]) for s in segs) < 5_000.0}
    assert got


SQUARE = [(0.0, 0.0), (10_000.0, 0.0), (10_000.0, 10_000.0), (0.0, 10_000.0)]
HOLE = [(4_000.0, 4_000.0), (6_000.0, 4_000.0), (6_000.0, 6_000.0), (4_000.0, 6_000.0)]


@pytest.fixture(scope="module")
def polygons(spark):
    rings = [[{"x": x, "y": y} for x, y in ring] for ring in (SQUARE, HOLE)]
    df = spark.createDataFrame([(1, rings)], "area long, rings array<array<struct<x:double,y:double>>>")
    return df.selectExpr("area", f"{G.ring_edges('rings')} AS edges")


def test_points_by_polygons(spark, polygons):
    cases = {1: (5_000.0, 2_000.0), 2: (5_000.0, 5_000.0), 3: (11_000.0, 5_000.0), 4: (10_500.0, 5_000.0), 5: (-9e5, 5.0)}
    pts = spark.createDataFrame([(k, *v) for k, v in cases.items()], "id long, x double, y double")

    def ids(**kw):
        return {r.id for r in spatial.points_by_polygons(pts, polygons, **kw).collect()}

    assert ids() == {1}
    assert ids(how="left_anti") == {2, 3, 4, 5}
    # the hole centre lies exactly 1 km from its edges: a point on the rim is not within
    assert ids(radius=1_000.0, how="left_anti") == {2, 3, 5}




def test_lines_clear_of_polygons(spark, polygons):
    lines = {
        1: [(-5_000.0, 5_000.0), (20_000.0, 5_000.0)],  # crosses
        2: [(11_000.0, -50_000.0), (11_000.0, 50_000.0)],  # touches the grown rim
        3: [(11_001.0, -50_000.0), (11_001.0, 50_000.0)],  # passes by
        4: [(90_000.0, 0.0), (80_000.0, 0.0), (1_000.0, 1_000.0)],  # ends inside
        5: [(1_000.0, 1_000.0), (2_000.0, 2_000.0)],  # wholly inside
    }
    rows = [(k, [{"x": x, "y": y} for x, y in v]) for k, v in lines.items()]
    df = spark.createDataFrame(rows, "road long, v array<struct<x:double,y:double>>")
    got = spatial.lines_clear_of_polygons(df, "road", "v", polygons, radius=1_000.0)
    assert {r.road for r in got.collect()} == {3}


def test_greedy_thinning_is_the_sequential_walk(spark):
    rng = random.Random(5)
    rows = [
        (i, float(rng.randrange(900_000)), float(rng.randrange(900_000)), rng.choice([1.5, 2.0, 2.5, 3.0]))
        for i in range(400)
    ]
    rows += [(1000 + i, rows[0][1], rows[0][2], 3.0) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, x double, y double, weight double")
    radius = 120_000.0
    kept = []
    for r in sorted(rows, key=lambda r: (-r[3], r[0])):
        if all(math.hypot(r[1] - k[1], r[2] - k[2]) > radius for k in kept):
            kept.append(r)
    got = greedy_thinning(df, radius, ["weight", "id"], descending=["weight"])
    assert {r.id for r in got.collect()} == {k[0] for k in kept}
    assert got.columns == df.columns


def test_thinning_of_nothing(spark):
    df = spark.createDataFrame([], "id long, x double, y double, weight double")
    assert greedy_thinning(df, 10.0, ["weight", "id"], descending=["weight"]).count() == 0


def test_projection_round_trip_and_known_points(spark):
    rows = [(-3.0, 40.0), (-9.0, 35.5), (4.5, 44.0), (2.1734, 41.3851), (0.0, 38.0)]
    df = spark.createDataFrame(rows, "lon double, lat double")
    df = G.with_utm30(df, "lon", "lat")
    for r in G.with_lonlat(df, "x", "y", "lon2", "lat2").collect():
        assert abs(r.lon - r.lon2) < 1e-9 and abs(r.lat - r.lat2) < 1e-9
    first = df.where("lon = -3").first()
    # meridian arc of GRS80 to 40 degrees is 4 429 529.030 m
    assert first.x == pytest.approx(500_000.0, abs=1e-6)
    assert first.y == pytest.approx(4_429_529.030 * 0.9996, abs=2e-3)


def test_line_interpolation(spark):
    v = [{"x": 0.0, "y": 0.0}, {"x": 3.0, "y": 4.0}, {"x": 3.0, "y": 9.0}]
    df = spark.createDataFrame([(v,)], "v array<struct<x:double,y:double>>")
    fractions = enumerate(["0D", "0.25D", "0.5D", "0.75D", "1D"])
    out = df.selectExpr(f"{G.line_length('v')} AS n", *(f"{G.point_along('v', f)} AS p{i}" for i, f in fractions)).first()
    assert out.n == 10.0
    assert [tuple(out[f"p{i}"]) for i in range(5)] == [(0, 0), (1.5, 2.0), (3, 4), (3, 6.5), (3, 9)]


def test_nearest_among_crowded_items(spark):
    rng = random.Random(8)
    items = [(i, 300_000 + rng.random() * 900, 4_200_000 + rng.random() * 900) for i in range(400)]
    places = [(i, 300_000 + rng.random() * 900, 4_200_000 + rng.random() * 900) for i in range(60)] + [(60, 1.0, 2.0)]
    left = spark.createDataFrame(places, "id long, x double, y double")
    right = spark.createDataFrame(items, "item long, x double, y double")
    levels, _ = spatial._crowded_levels(right, ["item"], "item", "point", spatial.PYRAMID, 4)
    assert len(levels) > len(spatial.PYRAMID)
    got = {r.id: r for r in spatial.nearest(left, right, ["item"], "item", crowd=4).collect()}
    for i, x, y in places:
        assert got[i].item == min((math.hypot(x - a, y - b), k) for k, a, b in items)[1]


def test_within_distance_among_crowded_lines(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(x, y, x + rng.random() * 50, y + rng.random() * 50) for x, y in ((rng.random() * 3_000, rng.random() * 3_000) for _ in range(300))]
    places = [(i, rng.random() * 3_000, rng.random() * 3_000) for i in range(120)]
    monkeypatch.setattr(spatial, "CROWD", 5)
    lines = spark.createDataFrame(rows, "x1 double, y1 double, x2 double, y2 double")
    got = spatial.within_distance_of_lines(spark.createDataFrame(places, "id long, x double, y double"), lines, 40.0)
    expected = [i for i, x, y in places if any(seg_dist(x, y, *r) < 40 for r in rows)]
    assert sorted(r.id for r in got.collect()) == expected and 0 < len(expected) < 120


@pytest.mark.parametrize("radius", [0.0, 700.0])
def test_detailed_outline_with_a_hole(spark, radius):
    def ring(r, n):
        wave = [r * (1 + 0.2 * math.sin(7 * k * 2 * math.pi / n)) for k in range(n)]
        return [{"x": 10_000 + w * math.cos(k * 2 * math.pi / n), "y": 5_000 + w * math.sin(k * 2 * math.pi / n)} for k, w in enumerate(wave)]

    rings = [ring(8_000, 300), ring(2_500, 90)]
    area = spark.createDataFrame([(rings,)], "rings array<array<struct<x:double,y:double>>>").selectExpr(f"{G.ring_edges('rings')} AS edges")
    rng = random.Random(4)
    places = [(i, rng.random() * 24_000 - 2_000, rng.random() * 24_000 - 7_000) for i in range(400)]
    left = spark.createDataFrame(places, "id long, x double, y double")

    def within(x, y):
        inside, near = False, False
        for r in rings:
            for p, q in zip(r, r[1:] + r[:1]):
                if (p["y"] > y) != (q["y"] > y) and x < (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"]:
                    inside = not inside
                near = near or seg_dist(x, y, p["x"], p["y"], q["x"], q["y"]) < radius
        return inside or near

    expected = [i for i, x, y in places if within(x, y)]
    for how, ids in (("left_semi", expected), ("left_anti", sorted({p[0] for p in places} - set(expected)))):
        got = spatial.points_by_polygons(left, area, radius=radius, how=how, cell=1_500.0)
        assert sorted(r.id for r in got.collect()) == ids


def crowd_and_roads(spark, crowded):
    """1,000 lines of a kilometre all over the map, and short ones in one spot far from them."""
    rng = random.Random(6)
    lines = [(i, x, y, x + 1_000.0, y) for i, (x, y) in enumerate((rng.random() * 600_000, 4_000_000 + rng.random() * 600_000) for _ in range(1_000))]
    spot = [(1_000 + i, 700_000 + rng.random() * 400, 4_700_000 + rng.random() * 400) for i in range(crowded)]
    lines += [(i, x, y, x + rng.random() * 3, y + rng.random() * 3) for i, x, y in spot]
    return lines, spark.createDataFrame(lines, "road long, x1 double, y1 double, x2 double, y2 double")


def test_a_crowded_cell_leaves_the_others_as_they_are(spark):
    lines, few = crowd_and_roads(spark, 0)
    whole, many = crowd_and_roads(spark, 6_000)
    counts = []
    for df in (few, many):
        levels, leaves = spatial._crowded_levels(df, ["road"], "road", "segment", spatial.PYRAMID, 256)
        far = leaves.where("x1 < 650000")
        counts.append((far.count(), far.agg(F.max("_lv")).first()[0], len(levels)))
        tree, split = spatial._line_tree(df, 10.0, 8_000.0)
        counts[-1] += (tree.where("x1 < 650000").count(), len(split))
    (pieces, depth, levels, cells, split), (pieces2, depth2, levels2, cells2, split2) = counts
    assert (pieces2, depth2, cells2) == (pieces, depth, cells) == (1_000, 2, cells)
    assert levels2 > levels == 3 and split2 > split == 0
    rng = random.Random(7)
    places = [(i, 700_000 + rng.random() * 400, 4_700_000 + rng.random() * 400) for i in range(40)]
    places += [(40 + i, rng.random() * 700_000, 4_000_000 + rng.random() * 700_000) for i in range(60)]
    left = spark.createDataFrame(places, "id long, x double, y double")
    got = {r.id: r for r in spatial.nearest(left, many, ["road"], "road", geometry="segment").collect()}
    for i, x, y in places:
        d, road = min((seg_dist(x, y, *s[1:]), s[0]) for s in whole)
        assert (got[i].road, got[i].distance_m) == (road, pytest.approx(d))
    near = {r.id for r in spatial.within_distance_of_lines(left, many, 10.0).collect()}
    assert near == {i for i, x, y in places if min(seg_dist(x, y, *s[1:]) for s in whole) < 10.0} and near


def test_long_lines_are_cut_finely_only_where_they_cross_the_crowd(spark):
    rng = random.Random(3)
    lines = [(i, 0.0, 4_000_000.0 + i, 900_000.0, 4_000_000.0 + i) for i in range(20)]
    lines += [(20 + i, x, y, x + 2.0, y) for i, (x, y) in enumerate((450_000 + rng.random() * 300, 4_000_000 + rng.random() * 300) for _ in range(2_000))]
    df = spark.createDataFrame(lines, "road long, x1 double, y1 double, x2 double, y2 double")
    _, leaves = spatial._crowded_levels(df, ["road"], "road", "segment", spatial.PYRAMID, 64)
    assert leaves.where("_item.road < 20").count() < 20 * 110 * 2
    places = [(i, 449_000 + rng.random() * 2_000, 3_999_900 + rng.random() * 600) for i in range(50)]
    left = spark.createDataFrame(places, "id long, x double, y double")
    got = {r.id: r.road for r in spatial.nearest(left, df, ["road"], "road", geometry="segment", crowd=64).collect()}
    assert got == {i: min((seg_dist(x, y, *s[1:]), s[0]) for s in lines)[1] for i, x, y in places}


def test_edges_are_copied_only_to_the_cells_they_pass(spark):
    """An outline of 20,000 vertices with a hole: few copies of each edge, whole inner cells without any."""
    n = 20_000

    def ring(r, wave, count):
        angle = [2 * math.pi * k / count for k in range(count)]
        return [(400_000 + r * (1 + wave * math.sin(9 * a)) * math.cos(a), 4_400_000 + r * (1 + wave * math.sin(9 * a)) * math.sin(a)) for a in angle]

    rings = [ring(300_000, 0.2, n), ring(60_000, 0.1, 2_000)]
    area = spark.createDataFrame([([[{"x": x, "y": y} for x, y in r] for r in rings],)], "rings array<array<struct<x:double,y:double>>>")
    cells = spatial.polygon_cells(area.selectExpr(f"{G.ring_edges('rings')} AS edges"), "edges", 0.0, 10_000.0).cache()
    assert cells.agg(F.sum(F.size("edges"))).first()[0] < 1.2 * (n + 2_000)
    assert cells.agg(F.max(F.size("edges"))).first()[0] < 400
    assert cells.where("size(edges) = 0").count() > 500 and cells.where("size(edges) = 0 AND NOT seed").count() == 0
    rng = random.Random(12)
    places = [(i, rng.random() * 800_000, 4_000_000 + rng.random() * 800_000) for i in range(600)]

    def inside(x, y):
        angle, r = math.atan2(y - 4_400_000, x - 400_000), math.hypot(x - 400_000, y - 4_400_000)
        return 60_000 * (1 + 0.1 * math.sin(9 * angle)) < r < 300_000 * (1 + 0.2 * math.sin(9 * angle))

    left = spark.createDataFrame(places, "id long, x double, y double")
    got = spatial.points_by_polygons(left, area.selectExpr(f"{G.ring_edges('rings')} AS edges"), cell=10_000.0)
    assert {r.id for r in got.collect()} == {i for i, x, y in places if inside(x, y)}


@pytest.mark.parametrize("cell", [3.0, 7.5, 100.0])
def test_places_on_vertices_and_edges_are_told_as_by_one_ray(spark, cell):
    rng = random.Random(21)
    rings = [[(rng.randrange(30) * 1.0, rng.randrange(30) * 1.0) for _ in range(9)], [(4.0, 4.0), (20.0, 4.0), (20.0, 20.0), (4.0, 20.0)]]
    areas = [([[{"x": x, "y": y} for x, y in r]],) for r in rings] + [([[{"x": x, "y": y} for x, y in r] for r in rings],)]
    places = [(i * 100 + j, float(i), float(j)) for i in range(-1, 32) for j in range(-1, 32)]
    left = spark.createDataFrame(places, "id long, x double, y double")
    for area in areas:
        df = spark.createDataFrame([area], "rings array<array<struct<x:double,y:double>>>").selectExpr(f"{G.ring_edges('rings')} AS edges")
        ray = left.crossJoin(df).where(G.inside_edges("x", "y", "edges"))
        got = spatial.points_by_polygons(left, df, cell=cell)
        assert {r.id for r in got.collect()} == {r.id for r in ray.collect()}


def dense_roads(spark, n, spread=20_000.0):
    """Long roads across one spot, and places in it and beside it."""
    rng = random.Random(31)
    lines = []
    for i in range(n):
        a, x, y = rng.random() * math.pi, 400_000 + rng.random() * spread, 4_400_000 + rng.random() * spread
        dx, dy = 30_000 * math.cos(a), 30_000 * math.sin(a)
        lines.append((i, x - dx, y - dy, x + dx, y + dy))
    places = [(i, 390_000 + rng.random() * 2 * spread, 4_390_000 + rng.random() * 2 * spread) for i in range(200)]
    places += [(200 + i, 480_000.0 + 10 * i, 4_400_000.0) for i in range(20)]
    places += [(300, None, 4_400_000.0), (301, *places[0][1:]), (302, *lines[0][1:3])]
    return (
        lines, spark.createDataFrame(lines, "road long, x1 double, y1 double, x2 double, y2 double"),
        places, spark.createDataFrame(places, "id long, x double, y double"),
    )


@pytest.fixture
def stored(monkeypatch):
    """Rows of each table that the operators store."""
    rows, store = [], spatial.materialise

    def count(df):
        kept = store(df)
        rows.append(kept.count())
        return kept

    monkeypatch.setattr(spatial, "materialise", count)
    return rows


def test_dense_lines_are_not_copied_for_places_near_them(spark, stored):
    lines, right, places, left = dense_roads(spark, 800)
    got = spatial.within_distance_of_lines(left, right, 500.0)
    expected = [i for i, x, y in places if x is not None and min(seg_dist(x, y, *s[1:]) for s in lines) < 500.0]
    assert sorted(r.id for r in got.collect()) == sorted(expected) and 100 < len(expected) < 220
    assert max(stored) <= len(lines)


def test_listed_cells_hold_a_place(spark):
    _, right, places, _ = dense_roads(spark, 800)
    spots = spark.createDataFrame([places[0][1:], places[1][1:]], "_px double, _py double")
    whole, _ = spatial._line_tree(right, 500.0, 8_000.0)
    listed, _ = spatial._line_tree(right, 500.0, 8_000.0, spots)
    assert 0 < listed.count() < whole.count() / 10


def test_nearest_of_dense_lines_stores_no_pieces(spark, stored):
    lines, right, places, left = dense_roads(spark, 800)
    got = {r.id: r for r in spatial.nearest(left.where("id < 100 OR id > 300"), right, ["road"], "road", geometry="segment").collect()}
    inside = [p for p in places if p[0] < 100 or p[0] > 300]
    for i, x, y in inside:
        d, road = min((seg_dist(x, y, *s[1:]), s[0]) for s in lines)
        assert (got[i].road, got[i].distance_m) == (road, pytest.approx(d, abs=1e-6))
    # no line is cut into stored pieces
    assert max(stored) <= len(lines)


def test_the_search_sorts_boxes_not_all_their_children(spark):
    items = spark.range(3_000).selectExpr("id", "cast(id * 7919 % 300000 AS double) AS x", "cast(id * 104729 % 300000 AS double) AS y")
    places = spark.range(200).selectExpr("cast(id * 31337 % 600000 AS double) AS x", "cast(id * 27449 % 600000 AS double) AS y")
    found = spatial.nearest(places, items, ["id"], "id")
    plan = [line.lstrip(" +-:") for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    windows = [k for k, line in enumerate(plan) if line.startswith("Window")]
    assert windows
    for k in windows:
        below = next(line for line in plan[k + 1 :] if not line.startswith(("Project", "Filter")))
        assert not below.startswith("Generate"), below
    known = [(r.id, r.x, r.y) for r in items.collect()]
    for r in found.collect():
        assert (r.distance_m, r.id) == min((math.hypot(r.x - x, r.y - y), i) for i, x, y in known)


def test_only_the_nearest_of_dense_lines_are_met(spark, monkeypatch):
    """Positions by dense lines, at borders of squares, and far from any line; sent in several turns."""
    lines, right, places, _ = dense_roads(spark, 800)
    lines = lines + [(800, 32_767.0, 4_390_912.0, 32_767.0, 4_400_000.0), (801, 32_767.0, 4_390_912.0, 32_767.0, 4_400_000.0)]
    right = spark.createDataFrame(lines, right.schema)
    places = [p for p in places[::2] if p[1] is not None] + [(400, 32_769.0, 4_390_911.0), (401, 35_000.0, 4_395_000.0), (402, 40_900.0, 4_391_000.0)]
    left = spark.createDataFrame(places, "id long, x double, y double")
    spots = spatial._positions(left, "x", "y")
    dist = G.point_segment_distance("_px", "_py", G.ends())
    met, _ = spatial._near_passing(spots, spatial._leaf_items(right, ["road"], "road", "segment"), dist)
    assert sum(m.count() for m in met) < 4 * spots.count()  # those of a cell's diagonal were met before
    monkeypatch.setattr(spatial, "SENT", 40)
    monkeypatch.setattr(spatial, "FEW", 2)
    got = {r.id: r for r in spatial.nearest(left, right, ["road"], "road", geometry="segment").collect()}
    for i, x, y in places:
        d, road = min((seg_dist(x, y, *s[1:]), s[0]) for s in lines)
        assert (got[i].road, got[i].distance_m) == (road, pytest.approx(d, abs=1e-6))


def test_lines_read_by_one_task_are_dealt_before_they_are_compared(spark, polygons):
    roads = spark.range(50, numPartitions=1).selectExpr("id AS road_id", "array(named_struct('x', id * 900D, 'y', 0D), named_struct('x', id * 900D, 'y', 9D)) AS v")
    clear = spatial.lines_clear_of_polygons(roads, "road_id", "v", polygons, radius=1_000.0, cell=10_000.0)
    assert "Repartition 4, true" in clear._jdf.queryExecution().optimizedPlan().toString()
    assert {r.road_id for r in clear.collect()} == {i for i in range(50) if i * 900 > 11_000}


@pytest.mark.parametrize("radius", [60.0, 50_000.0])
def test_places_farther_than_a_radius_from_every_item(spark, monkeypatch, radius):
    """Most places are told by cells: only those at the rim look for their nearest item."""
    rng, looked, search = random.Random(12), [], spatial.nearest
    monkeypatch.setattr(spatial, "nearest", lambda points, *a, **kw: looked.append(points.count()) or search(points, *a, **kw))
    items = [(rng.random() * 9 * radius, rng.random() * 9 * radius) for _ in range(4)] + [(None, 1.0)]
    places = [(i, (rng.random() * 13 - 2) * radius, (rng.random() * 13 - 2) * radius) for i in range(600)]
    places += [(600, None, 3.0), (601, items[0][0] + radius, items[0][1]), (602, *items[1])]
    left = spark.createDataFrame(places, "id long, x double, y double")
    right = spark.createDataFrame(items, "x double, y double")
    stay = [i for i, x, y in places if x is None or min(math.hypot(x - a, y - b) for a, b in items if a is not None) > radius]
    got = spatial.farther_than(left, right, radius)
    assert sorted(r.id for r in got.collect()) == stay and 100 < len(stay) < 600
    assert sum(looked) < 200
    assert spatial.farther_than(left, right.limit(0), radius).count() == len(places)


def test_positions_are_searched_in_all_tasks(spark):
    """Distinct positions are few bytes; the search over them must not be left to one task."""
    places = spark.range(3_000).selectExpr("cast(id * 7919 % 300000 AS double) AS x", "cast(id * 104729 % 300000 AS double) AS y")
    plan = spatial.nearest(places, places.selectExpr("x", "y", "x AS id"), ["id"], "id")._jdf.queryExecution().optimizedPlan().toString()
    assert "Repartition 4, true" in plan
    windows = plan.split("Window")[1:]
    assert windows and all(w.splitlines()[1].lstrip(" +-:").startswith("RepartitionByExpression") for w in windows if "\n" in w)
