"""Plane and ellipsoid geometry as SQL expressions.

Points are two numbers, segments four, polygons arrays of edges
``struct<x1,y1,x2,y2>``.  Functions take and return SQL expression text, which
one ``F.expr`` turns into a column: a formula of a hundred terms is then parsed
once in the JVM instead of being assembled call by call from Python, and it
stays inside generated code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# --------------------------------------------------------------------------
# transverse Mercator, zone 30 north on GRS80
# --------------------------------------------------------------------------
@dataclass(frozen=True)
class TransverseMercator:
    """Projection parameters with the sixth-order series derived from them."""

    semi_major: float = 6378137.0
    inverse_flattening: float = 298.257222101
    central_meridian: float = -3.0
    scale: float = 0.9996
    false_easting: float = 500000.0

    @property
    def n(self) -> float:
        f = 1.0 / self.inverse_flattening
        return f / (2.0 - f)

    @property
    def radius(self) -> float:
        n = self.n
        return self.semi_major / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256)

    @property
    def eccentricity(self) -> float:
        return 2.0 * math.sqrt(self.n) / (1.0 + self.n)

    def _series(self, table: list[list[tuple[int, int]]]) -> list[float]:
        """Row ``j`` holds the fractions that multiply n^j, n^(j+1), ..."""
        return [
            sum(num / den * self.n ** (j + k) for k, (num, den) in enumerate(row))
            for j, row in enumerate(table, start=1)
        ]

    @property
    def to_plane(self) -> list[float]:
        return self._series(
            [
                [(1, 2), (-2, 3), (5, 16), (41, 180), (-127, 288), (7891, 37800)],
                [(13, 48), (-3, 5), (557, 1440), (281, 630), (-1983433, 1935360)],
                [(61, 240), (-103, 140), (15061, 26880), (167603, 181440)],
                [(49561, 161280), (-179, 168), (6601661, 7257600)],
                [(34729, 80640), (-3418889, 1995840)],
                [(212378941, 319334400)],
            ]
        )

    @property
    def from_plane(self) -> list[float]:
        return self._series(
            [
                [(1, 2), (-2, 3), (37, 96), (-1, 360), (-81, 512), (96199, 604800)],
                [(1, 48), (1, 15), (-437, 1440), (46, 105), (-1118711, 3870720)],
                [(17, 480), (-37, 840), (-209, 4480), (5569, 90720)],
                [(4397, 161280), (-11, 504), (-830251, 7257600)],
                [(4583, 161280), (-108847, 3991680)],
                [(20648693, 638668800)],
            ]
        )

    @property
    def to_latitude(self) -> list[float]:
        return self._series(
            [
                [(2, 1), (-2, 3), (-2, 1), (116, 45), (26, 45), (-2854, 675)],
                [(7, 3), (-8, 5), (-227, 45), (2704, 315), (2323, 945)],
                [(56, 15), (-136, 35), (-1262, 105), (73814, 2835)],
                [(4279, 630), (-332, 35), (-399572, 14175)],
                [(4174, 315), (-144838, 6237)],
                [(601676, 22275)],
            ]
        )


UTM30 = TransverseMercator()


def with_lonlat(df: DataFrame, x: str = "x", y: str = "y", lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """Add degrees for metres in zone 30 north; null in, null out."""
    p = UTM30
    k = p.scale * p.radius
    xi, eta = "_xi", "_eta"
    xi0 = " - ".join(
        [xi, *(f"{b!r}D * sin({2 * j}D * {xi}) * cosh({2 * j}D * {eta})" for j, b in enumerate(p.from_plane, 1))]
    )
    eta0 = " - ".join(
        [eta, *(f"{b!r}D * cos({2 * j}D * {xi}) * sinh({2 * j}D * {eta})" for j, b in enumerate(p.from_plane, 1))]
    )
    phi = " + ".join(["_chi", *(f"{d!r}D * sin({2 * j}D * _chi)" for j, d in enumerate(p.to_latitude, 1))])
    kept = [c for c in df.columns if c not in (lon, lat)]
    step = df.select(
        *kept, F.expr(f"{y} / {k!r}D").alias(xi), F.expr(f"({x} - {p.false_easting!r}D) / {k!r}D").alias(eta)
    )
    step = step.select(*kept, F.expr(xi0).alias("_xi0"), F.expr(eta0).alias("_eta0"))
    step = step.select(*kept, "_xi0", "_eta0", F.expr("asin(sin(_xi0) / cosh(_eta0))").alias("_chi"))
    return step.select(
        *kept,
        F.expr(f"degrees(atan2(sinh(_eta0), cos(_xi0))) + ({p.central_meridian!r}D)").alias(lon),
        F.expr(f"degrees({phi})").alias(lat),
    )


def with_utm30(df: DataFrame, lon: str = "longitude", lat: str = "latitude", x: str = "x", y: str = "y") -> DataFrame:
    """Add metres in zone 30 north for degrees; null in, null out."""
    p = UTM30
    k, e = p.scale * p.radius, p.eccentricity
    kept = [c for c in df.columns if c not in (x, y)]
    step = df.select(
        *kept,
        F.expr(f"radians({lon} - ({p.central_meridian!r}D))").alias("_lam"),
        F.expr(f"sinh(atanh(sin(radians({lat}))) - {e!r}D * atanh({e!r}D * sin(radians({lat}))))").alias("_t"),
    )
    step = step.select(
        *kept,
        F.expr("atan2(_t, cos(_lam))").alias("_xi"),
        F.expr("atanh(sin(_lam) / sqrt(1D + _t * _t))").alias("_eta"),
    )
    xi = " + ".join(
        ["_xi", *(f"{a!r}D * sin({2 * j}D * _xi) * cosh({2 * j}D * _eta)" for j, a in enumerate(p.to_plane, 1))]
    )
    eta = " + ".join(
        ["_eta", *(f"{a!r}D * cos({2 * j}D * _xi) * sinh({2 * j}D * _eta)" for j, a in enumerate(p.to_plane, 1))]
    )
    return step.select(
        *kept,
        F.expr(f"{k!r}D * ({eta}) + {p.false_easting!r}D").alias(x),
        F.expr(f"{k!r}D * ({xi})").alias(y),
    )


EARTH_RADIUS_M = 6371008.8


def haversine_m(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """Great-circle distance in metres."""
    a = (
        f"pow(sin(radians(({lat2}) - ({lat1})) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * pow(sin(radians(({lon2}) - ({lon1})) / 2), 2)"
    )
    return f"{2 * EARTH_RADIUS_M!r}D * asin(least(1D, sqrt({a})))"


# --------------------------------------------------------------------------
# plane geometry
# --------------------------------------------------------------------------
Segment = tuple[str, str, str, str]


def ends(prefix: str = "") -> Segment:
    """Names of the four numbers of a segment."""
    return tuple(f"{prefix}{c}" for c in ("x1", "y1", "x2", "y2"))


def distance(x1: str, y1: str, x2: str, y2: str) -> str:
    """Straight distance of two points."""
    return f"sqrt(({x2} - {x1}) * ({x2} - {x1}) + ({y2} - {y1}) * ({y2} - {y1}))"


def point_segment_distance(px: str, py: str, seg: Segment) -> str:
    """Distance of a point to a segment; a segment of length zero is a point."""
    x1, y1, x2, y2 = seg
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    length2 = f"({dx} * {dx} + {dy} * {dy})"
    along = f"(({px} - {x1}) * {dx} + ({py} - {y1}) * {dy})"
    t = f"greatest(0D, least(1D, {along} / if({length2} > 0D, {length2}, 1D)))"
    ex, ey = f"({px} - {x1} - {t} * {dx})", f"({py} - {y1} - {t} * {dy})"
    return f"sqrt({ex} * {ex} + {ey} * {ey})"


def _side(a: tuple[str, str], b: tuple[str, str], c: tuple[str, str]) -> str:
    return f"(({b[0]} - {a[0]}) * ({c[1]} - {a[1]}) - ({b[1]} - {a[1]}) * ({c[0]} - {a[0]}) > 0D)"


def segments_cross(a: Segment, b: Segment) -> str:
    """True where the insides of two segments cross (touching ends have distance zero)."""
    a1, a2, b1, b2 = a[:2], a[2:], b[:2], b[2:]
    return (
        f"({_side(b1, b2, a1)} != {_side(b1, b2, a2)} AND {_side(a1, a2, b1)} != {_side(a1, a2, b2)})"
    )


def segments_within(a: Segment, b: Segment, radius: float) -> str:
    """True where two segments cross or come as near as ``radius``."""
    near = " OR ".join(
        f"{point_segment_distance(p[0], p[1], s)} <= {float(radius)!r}D"
        for p, s in ((a[:2], b), (a[2:], b), (b[:2], a), (b[2:], a))
    )
    return f"({segments_cross(a, b)} OR {near})"


def inside_edges(px: str, py: str, edges: str) -> str:
    """Even-odd test of a point against the edges of all rings of a polygon."""
    spans = f"((e.y1 > {py}) != (e.y2 > {py}))"
    at = f"((e.x2 - e.x1) * ({py} - e.y1) / if({spans}, e.y2 - e.y1, 1D) + e.x1)"
    return f"(size(filter({edges}, e -> {spans} AND {px} < {at})) % 2 = 1)"


def crossings_right(px: str, py: str, edges: str, limit: str) -> str:
    """Number of edges that a ray from a point to the right crosses, up to ``limit``."""
    spans = f"((e.y1 > {py}) != (e.y2 > {py}))"
    at = f"((e.x2 - e.x1) * ({py} - e.y1) / if({spans}, e.y2 - e.y1, 1D) + e.x1)"
    return f"size(filter({edges}, e -> {spans} AND {px} < {at} AND {at} <= {limit}))"


def crossings_below(x: str, low: str, py: str, edges: str) -> str:
    """Number of edges that cross a vertical line between ``low`` and a height, the height included."""
    spans = f"((e.x1 > {x}) != (e.x2 > {x}))"
    at = f"((e.y2 - e.y1) * ({x} - e.x1) / if({spans}, e.x2 - e.x1, 1D) + e.y1)"
    return f"size(filter({edges}, e -> {spans} AND {at} > {low} AND {at} <= {py}))"


def near_edges(px: str, py: str, edges: str, radius: float) -> str:
    """Point strictly nearer than ``radius`` to the outline of a polygon."""
    return f"exists({edges}, e -> {point_segment_distance(px, py, ends('e.'))} < {float(radius)!r}D)"


def within_buffer(px: str, py: str, edges: str, radius: float = 0.0) -> str:
    """Point strictly inside the polygon grown by ``radius`` (a point on the rim is not within)."""
    inside = inside_edges(px, py, edges)
    return f"({inside} OR {near_edges(px, py, edges, radius)})" if radius > 0 else inside


def ring_edges(rings: str) -> str:
    """``array<array<struct<x,y>>>`` to one array of edges, closing each ring."""
    edge = "named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y)"
    shifted = "concat(slice(r, 2, greatest(size(r) - 1, 0)), slice(r, 1, 1))"
    closed = f"filter(zip_with(r, {shifted}, (p, q) -> {edge}), e -> e.x1 != e.x2 OR e.y1 != e.y2)"
    return f"flatten(transform({rings}, r -> {closed}))"


def line_segments(vertices: str) -> str:
    """Vertices of a line to an array of its segments."""
    count = f"greatest(size({vertices}) - 1, 0)"
    edge = "named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y)"
    return f"zip_with(slice({vertices}, 1, {count}), slice({vertices}, 2, {count}), (p, q) -> {edge})"


def line_length(vertices: str) -> str:
    """Length of a line."""
    return f"aggregate({line_segments(vertices)}, 0D, (acc, s) -> acc + {distance('s.x1', 's.y1', 's.x2', 's.y2')})"


def point_along(vertices: str, fraction: str) -> str:
    """``struct<x,y>`` at a fraction of the length of a line (0 first vertex, 1 last vertex).

    Walks the segments with the distance still to go and stops moving once the
    target lies on a segment.
    """
    length = distance("s.x1", "s.y1", "s.x2", "s.y2")
    start = (
        f"named_struct('left', {line_length(vertices)} * ({fraction}), 'x', {vertices}[0].x, 'y', {vertices}[0].y)"
    )
    share = f"(a.left / {length})"
    step = (
        "CASE WHEN a.left <= 0D THEN a"
        f" WHEN a.left < {length} THEN named_struct('left', 0D,"
        f" 'x', s.x1 + (s.x2 - s.x1) * {share}, 'y', s.y1 + (s.y2 - s.y1) * {share})"
        f" ELSE named_struct('left', a.left - {length}, 'x', s.x2, 'y', s.y2) END"
    )
    walked = f"aggregate({line_segments(vertices)}, {start}, (a, s) -> {step}, a -> named_struct('x', a.x, 'y', a.y))"
    last = f"named_struct('x', element_at({vertices}, -1).x, 'y', element_at({vertices}, -1).y)"
    return f"if(({fraction}) >= 1D, {last}, {walked})"


def line_meets_box(vertices: str, x_range: tuple[float, float], y_range: tuple[float, float]) -> str:
    """A segment of the line has a point in the closed box.

    Extents overlap and the corners of the box do not all lie on one side of the
    segment's line: no axis separates the two.
    """
    extent = " AND ".join(
        f"greatest(s.{c}1, s.{c}2) >= {low!r}D AND least(s.{c}1, s.{c}2) <= {high!r}D"
        for c, (low, high) in (("x", x_range), ("y", y_range))
    )
    sides = [f"(s.x2 - s.x1) * ({y!r}D - s.y1) - (s.y2 - s.y1) * ({x!r}D - s.x1)" for x in x_range for y in y_range]
    apart = f"least({', '.join(sides)}) > 0D OR greatest({', '.join(sides)}) < 0D"
    return f"exists({line_segments(vertices)}, s -> {extent} AND NOT ({apart}))"
