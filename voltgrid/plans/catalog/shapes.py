"""Feature collections with bent lines, lines of several parts and areas with holes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import settings as S
from ...functions import geodesy as G
from ...operators import spatial
from ...sources import geojson
from .. import bindings as b
from ..registry import query, sql, view
from .files import _folder
from .network import _E, _R, crosses, point_segment

#: half sides of the square areas and of the holes in them (no point of the tables lies on a rim)
OUTER, HOLE = 60_000.5, 25_000.25
#: features in a collection, which is one document and so one task's work
PER_FILE = 500
#: a bend halfway, a quarter of the length aside; a spur of 4 km starts there
_BEND = ("(x1 + x2) / 2 - (y2 - y1) / 4", "(y1 + y2) / 2 + (x2 - x1) / 4")
_SPUR = 4_000.0


def _ring(half: float) -> str:
    corners = [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+"), ("-", "-")]
    return f"array({', '.join(f'array(cx {a} {half!r}D, cy {c} {half!r}D)' for a, c in corners)})"


def _collections(rows: DataFrame, number: str, properties: str, kind: str, coordinates: str, path: str) -> None:
    """Files of one collection each, `PER_FILE` features in it."""
    feature = f"""named_struct('type', 'Feature', 'properties', named_struct({properties}),
                  'geometry', named_struct('type', '{kind}', 'coordinates', {coordinates}))"""
    documents = rows.selectExpr(f"{number} div {PER_FILE} AS file", f"{feature} AS feature").groupBy("file")
    documents.agg(F.lit("FeatureCollection").alias("type"), F.collect_list("feature").alias("features")).write.partitionBy(
        "file"
    ).json(path)


def _bent_roads(spark, sf) -> DataFrame:
    """Roads from a file: a bent part and a spur, a row each."""
    path = _folder(spark, "bent")
    ends = b.roads(spark, sf).selectExpr("road_id", "vertices[0].x AS x1", "vertices[0].y AS y1", "vertices[1].x AS x2", "vertices[1].y AS y2")
    bent = ends.selectExpr("*", f"{_BEND[0]} AS mx", f"{_BEND[1]} AS my")
    parts = f"array(array(array(x1, y1), array(mx, my), array(x2, y2)), array(array(mx, my), array(mx, my + {_SPUR!r}D)))"
    _collections(bent, "road_id", "'road_id', road_id", "MultiLineString", parts, path)
    return geojson.read_lines(spark, path, {"road_id": "long"}, project=False)


def _ringed_areas(spark, sf) -> DataFrame:
    """Square areas with square holes, from a file."""
    path = _folder(spark, "ringed")
    areas = b._view(spark, sf, b.URBAN, "nation")
    _collections(areas, "area_id", "'area_id', area_id", "Polygon", f"array({_ring(OUTER)}, {_ring(HOLE)})", path)
    return geojson.read_polygons(spark, path, {"area_id": "long"}, project=False)


view("bends", f"SELECT road_id, x1, y1, x2, y2, {_BEND[0]} AS mx, {_BEND[1]} AS my FROM roads", "roads")
view(
    "bent_segments",
    f"""SELECT road_id, 0 AS part, x1, y1, mx AS x2, my AS y2 FROM bends UNION ALL SELECT road_id, 0, mx, my, x2, y2 FROM bends
        UNION ALL SELECT road_id, 1, mx, my, mx, my + {_SPUR} FROM bends""",
    "bends",
)


@query(
    "feature_collections",
    sql(
        f"""SELECT 'line' AS kind, road_id AS id, part, CAST(count(*) + 1 AS INTEGER) AS n_vertices,
                   round(sum(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2))), 3) AS size FROM bent_segments GROUP BY road_id, part
            UNION ALL SELECT 'area', area_id, 0, 8, round(CAST({(2 * OUTER) ** 2 + (2 * HOLE) ** 2} AS DOUBLE), 3) FROM urban
            UNION ALL SELECT 'point', site_id, 0, 1, round(x + y, 3) FROM sites""",
        "bent_segments",
        "urban",
        "sites",
    ),
)
def feature_collections(spark, sf):
    """Points, lines of two parts and areas with holes, each from collections of features."""
    path = _folder(spark, "points")
    _collections(b.sites(spark, sf), "site_id", "'site_id', site_id", "Point", "array(x, y)", path)
    points = geojson.read_points(spark, path, {"site_id": "long"}).selectExpr(
        "'point' AS kind", "site_id AS id", "0 AS part", "1 AS n_vertices", "round(longitude + latitude, 3) AS size"
    )
    lines = _bent_roads(spark, sf).selectExpr(
        "'line' AS kind", "road_id AS id", "part", "size(vertices) AS n_vertices", f"round({G.line_length('vertices')}, 3) AS size"
    )
    # both squares count as positive here: the sum of the squared sides of the two rings
    square = "aggregate(edges, 0D, (s, e) -> s + pow(e.x2 - e.x1, 2) + pow(e.y2 - e.y1, 2)) / 4"
    areas = _ringed_areas(spark, sf).selectExpr("'area' AS kind", "area_id AS id", "0 AS part", "size(edges) AS n_vertices", f"round({square}, 3) AS size")
    return points.unionByName(lines).unionByName(areas)


def _rim(half: float) -> str:
    corners = [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+")]
    turned = corners[1:] + corners[:1]
    return " UNION ALL ".join(
        f"SELECT cx {a} {half} AS x1, cy {c} {half} AS y1, cx {d} {half} AS x2, cy {e} {half} AS y2 FROM urban"
        for (a, c), (d, e) in zip(corners, turned)
    )


def _in_ring(x: str, y: str) -> str:
    apart = f"greatest(abs({x} - u.cx), abs({y} - u.cy))"
    return f"EXISTS (SELECT 1 FROM urban u WHERE {apart} < {OUTER} AND {apart} > {HOLE})"


view("rims", f"{_rim(OUTER)} UNION ALL {_rim(HOLE)}", "urban")


@query(
    "sites_in_ringed_areas",
    sql(f"SELECT site_id FROM sites s WHERE {_in_ring('s.x', 's.y')}", "sites", "urban"),
)
def sites_in_ringed_areas(spark, sf):
    """Sites in an area; those in its hole are not in it."""
    return spatial.points_by_polygons(b.sites(spark, sf), _ringed_areas(spark, sf)).select("site_id")


_U = S.URBAN_BUFFER_M


@query(
    "bent_roads_clear_of_rings",
    sql(
        f"""SELECT DISTINCT road_id FROM roads WHERE road_id NOT IN (
              SELECT r.road_id FROM bent_segments r, rims e
              WHERE {point_segment('r.x1', 'r.y1', *_E)} <= {_U} OR {point_segment('r.x2', 'r.y2', *_E)} <= {_U}
                 OR {point_segment('e.x1', 'e.y1', *_R)} <= {_U} OR {point_segment('e.x2', 'e.y2', *_R)} <= {_U}
                 OR {crosses(_R, _E)}
              UNION ALL SELECT r.road_id FROM bent_segments r WHERE {_in_ring('r.x1', 'r.y1')})""",
        "roads",
        "bent_segments",
        "rims",
        "urban",
    ),
)
def bent_roads_clear_of_rings(spark, sf):
    """Roads that stay clear of the grown areas: far from them, or wholly in a hole."""
    kept = spatial.lines_clear_of_polygons(_bent_roads(spark, sf), "road_id", "vertices", _ringed_areas(spark, sf), radius=_U)
    return kept.select("road_id").distinct()


@query(
    "sites_near_bent_roads",
    sql(
        f"""SELECT site_id FROM sites s WHERE EXISTS (
              SELECT 1 FROM bent_segments r WHERE {point_segment('s.x', 's.y', *_R)} < {S.HIGHWAY_BUFFER_M})""",
        "sites",
        "bent_segments",
    ),
)
def sites_near_bent_roads(spark, sf):
    segments = spatial.line_to_segments(_bent_roads(spark, sf), "vertices", ["road_id"])
    return spatial.within_distance_of_lines(b.sites(spark, sf), segments, S.HIGHWAY_BUFFER_M).select("site_id")
