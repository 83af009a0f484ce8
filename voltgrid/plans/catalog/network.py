"""Interurban sites, expansion, gap filling, grid status, result tables."""

from pyspark.sql import functions as F

from ... import settings as S
from ...functions.scoring import growth_multiplier
from ...operators import network as N
from ...operators.spatial import points_by_polygons
from .. import bindings as b
from ..demand import DemandPlan
from ..network import NetworkPlan
from ..registry import query, sql, view
from . import demand as D
from .flows import lonlat_sql



def growth(spark, sf, plan: DemandPlan):
    """The planning number over the full electric fleet registered so far (both read as scalars)."""
    fleet = b.registrations(spark, sf).agg(F.count_if(F.col("ev_category") == "BEV").alias("fleet"))
    return growth_multiplier(plan.planning_number.scalar(), fleet.scalar())


def network(spark, sf, plan: DemandPlan | None = None) -> NetworkPlan:
    return NetworkPlan(
        b.sites(spark, sf),
        b.roads(spark, sf),
        b.urban_areas(spark, sf),
        b.country(spark),
        b.substations(spark, sf),
        growth(spark, sf, plan or D.demand(spark, sf)),
    )


def places(spark, sf) -> NetworkPlan:
    """The plan for what does not depend on growth."""
    return NetworkPlan(
        b.sites(spark, sf), b.roads(spark, sf), b.urban_areas(spark, sf), b.country(spark), b.substations(spark, sf), F.lit(1.0)
    )


# ---- geometry in SQL, all with all ------------------------------------------------
def point_segment(px, py, x1, y1, x2, y2) -> str:
    dx, dy = f"({x2} - {x1})", f"({y2} - {y1})"
    l2 = f"({dx} * {dx} + {dy} * {dy})"
    t = f"greatest(0, least(1, (({px} - {x1}) * {dx} + ({py} - {y1}) * {dy}) / (CASE WHEN {l2} > 0 THEN {l2} ELSE 1 END)))"
    return f"sqrt(pow({px} - {x1} - {t} * {dx}, 2) + pow({py} - {y1} - {t} * {dy}, 2))"


def side(ax, ay, bx, by, cx, cy) -> str:
    return f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}) > 0)"


def crosses(a, c) -> str:
    return (
        f"({side(*c, a[0], a[1])} <> {side(*c, a[2], a[3])} AND {side(*a, c[0], c[1])} <> {side(*a, c[2], c[3])})"
    )


H = b.URBAN_HALF
view(
    "kept_roads",
    """SELECT * FROM roads WHERE type IN ('Major Highway', 'Secondary Highway')
         AND regexp_matches(upper(coalesce(label, '')), '^(AP|A|E|N)')""",
    "roads",
)
view(
    "urban_edges",
    f"""SELECT area_id, cx - {H} AS x1, cy - {H} AS y1, cx + {H} AS x2, cy - {H} AS y2 FROM urban
        UNION ALL SELECT area_id, cx + {H}, cy - {H}, cx + {H}, cy + {H} FROM urban
        UNION ALL SELECT area_id, cx + {H}, cy + {H}, cx - {H}, cy + {H} FROM urban
        UNION ALL SELECT area_id, cx - {H}, cy + {H}, cx - {H}, cy - {H} FROM urban""",
    "urban",
)
_R = ("r.x1", "r.y1", "r.x2", "r.y2")
_E = ("e.x1", "e.y1", "e.x2", "e.y2")
_U = S.URBAN_BUFFER_M
view(
    "road_set",
    f"""SELECT * FROM kept_roads WHERE road_id NOT IN (
          SELECT r.road_id FROM kept_roads r, urban_edges e
          WHERE {point_segment('r.x1', 'r.y1', *_E)} <= {_U} OR {point_segment('r.x2', 'r.y2', *_E)} <= {_U}
             OR {point_segment('e.x1', 'e.y1', *_R)} <= {_U} OR {point_segment('e.x2', 'e.y2', *_R)} <= {_U}
             OR {crosses(_R, _E)}
          UNION ALL SELECT r.road_id FROM kept_roads r, urban u
          WHERE abs(r.x1 - u.cx) < {H} AND abs(r.y1 - u.cy) < {H})""",
    "kept_roads",
    "urban_edges",
    "urban",
)


def urban_free(source: str, key: str) -> str:
    """Rows of ``source`` outside the grown urban squares."""
    return f"""SELECT s.* FROM {source} s WHERE NOT EXISTS (
          SELECT 1 FROM urban u WHERE abs(s.x - u.cx) < {H} AND abs(s.y - u.cy) < {H})
        AND NOT EXISTS (SELECT 1 FROM urban_edges e WHERE {point_segment('s.x', 's.y', *_E)} < {_U})"""


view(
    "near_sites",
    f"""SELECT s.* FROM sites s WHERE EXISTS (
          SELECT 1 FROM road_set r WHERE {point_segment('s.x', 's.y', *_R)} < {S.HIGHWAY_BUFFER_M})""",
    "sites",
    "road_set",
)
view("stations", urban_free("near_sites", "site_id"), "near_sites", "urban", "urban_edges")
_SITE = "site_id, name, x, y, n_connectors, operator"


@query("interurban_roads", sql("SELECT road_id, label, type FROM road_set", "road_set"))
def interurban_roads(spark, sf):
    return N.interurban_roads(N.main_roads(b.roads(spark, sf)), b.urban_areas(spark, sf)).select("road_id", "label", "type")


@query("interurban_sites", sql(f"SELECT {_SITE} FROM stations", "stations"))
def interurban_sites(spark, sf):
    return places(spark, sf).stations


_BOX = ((200_000.0, 500_000.0), (4_100_000.0, 4_500_000.0))


def _share(c: str, low: float, high: float) -> str:
    """[from, to] of the parameters at which a segment is between two sides; [1, 0] if never."""
    a, step = f"{c}1", f"({c}2 - {c}1)"
    ends = f"({low} - {a}) / {step}, ({high} - {a}) / {step}"
    return (
        f"CASE WHEN {step} <> 0 THEN [least({ends}), greatest({ends})]"
        f" WHEN {a} BETWEEN {low} AND {high} THEN [0.0, 1.0] ELSE [1.0, 0.0] END"
    )



@query(
    "roads_in_box",
    # the part of the segment, from 0 to 1, that lies between each pair of sides
    sql(
        f"""SELECT road_id FROM (SELECT road_id, {_share('x', *_BOX[0])} AS sx, {_share('y', *_BOX[1])} AS sy FROM kept_roads)
            WHERE greatest(sx[1], sy[1], 0) <= least(sx[2], sy[2], 1)""",
        "kept_roads",
    ),
)
def roads_in_box(spark, sf):
    return N.main_roads(b.roads(spark, sf), box=_BOX).select("road_id")


@query(
    "boxed_network",
    sql(
        f"""SELECT road_id, label FROM (SELECT *, {_share('x', *_BOX[0])} AS sx, {_share('y', *_BOX[1])} AS sy FROM road_set)
            WHERE greatest(sx[1], sy[1], 0) <= least(sx[2], sy[2], 1)""",
        "road_set",
    ),
)
def boxed_network(spark, sf):
    """The chain's roads inside a box; their label comes under another name, the first known one counts."""
    roads = b.roads(spark, sf).withColumnRenamed("label", "road_number")
    plan = NetworkPlan(
        b.sites(spark, sf), roads, b.urban_areas(spark, sf), b.country(spark), b.substations(spark, sf), F.lit(1.0),
        labels=("ref", "road_number", "type"), box=_BOX,
    )
    return plan.roads.select("road_id", "label")


# ---- expand -----------------------------------------------------------------------
def weight(label: str, default: float) -> str:
    cases = " ".join(
        f"WHEN starts_with(upper(trim({label})), '{p}') THEN {w}"
        for p, w in sorted(S.ROAD_WEIGHTS.items(), key=lambda kv: -len(kv[0]))
    )
    return f"CAST(CASE {cases} ELSE {default} END AS DOUBLE)"


def segment_label(label: str) -> str:
    return rf"regexp_replace(upper(trim({label})), '^(AP|A|E|N)(\d.*)', '\1-\2')"


view(
    "growth",
    f"""SELECT (SELECT {S.DEMAND_METRIC} FROM planning WHERE scenario = 'normal')
             / count(CASE WHEN ev_category = 'BEV' THEN 1 END) AS g FROM reg""",
    "reg",
    "planning",
)
view(
    "snapped",
    f"""SELECT s.site_id, arg_min(struct_pack(road_id := r.road_id, label := r.label),
                 struct_pack(d := {point_segment('s.x', 's.y', *_R)}, id := r.road_id)) AS road
        FROM stations s CROSS JOIN road_set r GROUP BY s.site_id""",
    "stations",
    "road_set",
)
view(
    "pressure",
    f"""SELECT s.*, n.road.road_id AS road_id, coalesce(n.road.label, '{S.UNKNOWN_ROAD}') AS road_name,
               {weight(f"coalesce(n.road.label, '{S.UNKNOWN_ROAD}')", S.STATION_DEFAULT_WEIGHT)} AS road_weight,
               round_even((SELECT g FROM growth) * {weight(f"coalesce(n.road.label, '{S.UNKNOWN_ROAD}')", S.STATION_DEFAULT_WEIGHT)}
                          / greatest(coalesce(s.n_connectors, 1), 1), 3) AS pressure_score,
               {segment_label(f"coalesce(n.road.label, '{S.UNKNOWN_ROAD}')")} AS route_segment
        FROM stations s LEFT JOIN snapped n USING (site_id)""",
    "stations",
    "snapped",
    "growth",
)
view(
    "expand",
    f"""SELECT * FROM pressure WHERE pressure_score >= (SELECT quantile_cont(pressure_score, {1 - S.EXPAND_SHARE}) FROM pressure)""",
    "pressure",
)


@query(
    "site_road_snap",
    sql("SELECT site_id, road_id, road_name, road_weight, pressure_score, route_segment FROM pressure", "pressure"),
)
def site_road_snap(spark, sf):
    plan = network(spark, sf)
    scored = N.station_pressure(N.snap_to_road(plan.stations, plan.roads), plan.growth)
    return scored.select("site_id", "road_id", "road_name", "road_weight", "pressure_score", "route_segment")


@query(
    "expand_sites",
    sql("SELECT site_id, x, y, route_segment, pressure_score FROM expand", "expand"),
)
def expand_sites(spark, sf):
    return network(spark, sf).expand.select("site_id", "x", "y", "route_segment", "pressure_score")


# ---- fill --------------------------------------------------------------------------
view(
    "candidates",
    f"""SELECT road_id, CAST(step AS INTEGER) AS step,
               CASE WHEN step = steps THEN x2 ELSE x1 + (x2 - x1) * (step / steps) END AS x,
               CASE WHEN step = steps THEN y2 ELSE y1 + (y2 - y1) * (step / steps) END AS y,
               coalesce(nullif(label, ''), '{S.UNKNOWN_ROAD}') AS road_name,
               {weight(f"coalesce(nullif(label, ''), '{S.UNKNOWN_ROAD}')", S.CANDIDATE_DEFAULT_WEIGHT)} AS road_weight
        FROM (SELECT *, greatest(1, CAST(floor(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)) / {S.FILL_SPACING_M}) AS BIGINT)) AS steps
              FROM road_set) r, LATERAL (SELECT unnest(range(0, r.steps + 1)) AS step) g""",
    "road_set",
)
_RING = [
    (*p, *q) for p, q in zip(b.COUNTRY_RING, b.COUNTRY_RING[1:] + b.COUNTRY_RING[:1])
]


def in_country(x: str, y: str) -> str:
    terms = " + ".join(
        f"CAST((({y1} > {y}) <> ({y2} > {y})) AND {x} < ({x2} - {x1}) * ({y} - {y1}) / ({y2 - y1}) + {x1} AS INTEGER)"
        for x1, y1, x2, y2 in _RING
    )
    return f"({terms}) % 2 = 1"


view("inside", f"SELECT * FROM candidates WHERE {in_country('x', 'y')}", "candidates")
view("rural", urban_free("inside", "road_id"), "inside", "urban", "urban_edges")
view(
    "gaps",
    f"""SELECT c.* FROM rural c WHERE NOT EXISTS (
          SELECT 1 FROM stations s WHERE sqrt(pow(c.x - s.x, 2) + pow(c.y - s.y, 2)) <= {S.FILL_EXCLUSION_M})""",
    "rural",
    "stations",
)


@query(
    "road_candidates",
    sql("SELECT road_id, step, round(x, 3) AS x, round(y, 3) AS y, road_name, road_weight FROM candidates", "candidates"),
)
def road_candidates(spark, sf):
    points = N.road_candidates(places(spark, sf).roads)
    return points.withColumns({"x": F.round("x", 3), "y": F.round("y", 3)})


@query(
    "fill_candidates",
    sql("SELECT road_id, step, round(x, 3) AS x, round(y, 3) AS y, road_name, road_weight FROM gaps", "gaps"),
)
def fill_candidates(spark, sf):
    return places(spark, sf).fill.withColumns({"x": F.round("x", 3), "y": F.round("y", 3)})




def walk_views(source: str, spacing: float, suffix: str = "") -> None:
    """Views of the walk over ``source``: each step adds the first candidate that keeps the spacing to all kept so far."""
    order, kept = f"walk_order{suffix}", f"kept{suffix}"
    view(order, f"SELECT *, row_number() OVER (ORDER BY road_weight DESC, road_id, step) AS rk FROM {source}", source)
    view(
        kept,
        f"""SELECT rk, kept FROM (SELECT rk, [struct_pack(x := x, y := y)] AS kept FROM {order} ORDER BY rk LIMIT 1) AS seed
            UNION ALL
            SELECT n.rk, list_append(n.kept, struct_pack(x := c.x, y := c.y))
            FROM (SELECT min(c.rk) AS rk, any_value(k.kept) AS kept FROM {kept} k JOIN {order} c ON c.rk > k.rk
                  WHERE list_min(list_transform(k.kept, lambda p: pow(p.x - c.x, 2) + pow(p.y - c.y, 2))) > {spacing**2}
                  HAVING count(*) > 0) n
            JOIN {order} c ON c.rk = n.rk""",
        order,
    )
    view(f"thinned{suffix}", f"SELECT w.* FROM {order} w WHERE rk IN (SELECT rk FROM {kept})", order, kept)


walk_views("gaps", S.FILL_SPACING_M)
#: many places that stand close: the same walk over all rural candidates
DENSE_SPACING_M = 40_000.0
walk_views("rural", DENSE_SPACING_M, "_dense")


def walk_sql(final: str, *reads: str) -> str:
    return sql(final, *reads)


@query(
    "fill_thinned",
    walk_sql("SELECT road_id, step, round(x, 3) AS x, round(y, 3) AS y, road_name, road_weight FROM thinned", "thinned"),
)
def fill_thinned(spark, sf):
    return places(spark, sf).thinned.withColumns({"x": F.round("x", 3), "y": F.round("y", 3)})


@query(
    "rural_thinned",
    walk_sql("SELECT road_id, step, round(x, 3) AS x, round(y, 3) AS y, road_weight FROM thinned_dense", "thinned_dense"),
)
def rural_thinned(spark, sf):
    """The same thinning where hundreds of places stay, whatever stations are near."""
    plan = places(spark, sf)
    inside = N.clip_to_country(N.road_candidates(plan.roads), plan.country)
    rural = points_by_polygons(inside, plan.urban, radius=S.URBAN_BUFFER_M, how="left_anti")
    kept = N.thin_candidates(rural, DENSE_SPACING_M)
    return kept.select("road_id", "step", F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "road_weight")


# ---- proposals -----------------------------------------------------------------------
view(
    "all_places",
    f"""SELECT x, y, route_segment, 'EXPAND' AS station_type, pressure_score, 0 AS type_rank, 0.0 AS weight_rank,
               site_id AS source_id, 0 AS step FROM expand
        UNION ALL SELECT x, y, {segment_label('road_name')}, 'FILL', 0.0, 1, -road_weight, road_id, step FROM thinned""",
    "expand",
    "thinned",
)
_ORDER = "type_rank, weight_rank, source_id, step"
view(
    "places",
    f"""SELECT *, row_number() OVER (PARTITION BY x, y ORDER BY {_ORDER}) AS copy FROM all_places WHERE {in_country('x', 'y')}""",
    "all_places",
)
view(
    "rated",
    f"""SELECT p.*, CASE WHEN mw * 1000 >= {S.SUFFICIENT_KW} THEN 'Sufficient' WHEN mw * 1000 >= {S.MODERATE_KW} THEN 'Moderate'
                    ELSE 'Congested' END AS grid_status
        FROM (SELECT p.*, (SELECT arg_min(s.capacity_available_mw,
                  struct_pack(d := sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)), id := s.substation_id))
                FROM subs s WHERE s.capacity_available_mw IS NOT NULL) AS mw
              FROM places p WHERE copy = 1) p""",
    "places",
    "subs",
)
view(
    "proposed",
    lonlat_sql("rated", f"x, y, route_segment, station_type, pressure_score, grid_status, {_ORDER}"),
    "rated",
)


@query(
    "proposed_stations",
    walk_sql(
        f"""SELECT printf('IBE_%03d', row_number() OVER (ORDER BY {_ORDER})) AS location_id,
                   round(latitude, 6) AS latitude, round(longitude, 6) AS longitude, route_segment,
                   CAST({S.CHARGERS_PER_STATION} AS INTEGER) AS n_chargers_proposed, grid_status, station_type,
                   CAST(pressure_score AS DOUBLE) AS pressure_score FROM proposed""",
        "proposed",
    ),
)
def proposed_stations(spark, sf):
    return D.rounded(network(spark, sf).proposed_stations, 6, "latitude", "longitude")


view(
    "friction",
    f"""SELECT p.*, row_number() OVER (ORDER BY {_ORDER}) AS rn,
               (SELECT arg_min(s.grid_operator, struct_pack(d := sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)), id := s.substation_id))
                FROM subs s) AS network FROM proposed p WHERE grid_status <> 'Sufficient'""",
    "proposed",
    "subs",
)


@query(
    "friction_points",
    walk_sql(
        f"""SELECT printf('FRIC_%03d', rn) AS bottleneck_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude,
                   route_segment, CAST({S.CHARGERS_PER_STATION} AS INTEGER) AS n_chargers_proposed, grid_status,
                   CAST({S.DEMAND_KW} AS INTEGER) AS estimated_demand_kw,
                   CASE network WHEN 'Iberdrola i-DE' THEN 'i-DE' WHEN 'Endesa e-distribución' THEN 'Endesa'
                        WHEN 'Viesgo' THEN 'Viesgo' ELSE 'i-DE' END AS distributor_network FROM friction""",
        "friction",
    ),
)
def friction_points(spark, sf):
    return D.rounded(network(spark, sf).friction_points, 6, "latitude", "longitude")


@query(
    "friction_by_network",
    walk_sql(
        """SELECT grid_status, CASE network WHEN 'Iberdrola i-DE' THEN 'i-DE' WHEN 'Endesa e-distribución' THEN 'Endesa'
                  WHEN 'Viesgo' THEN 'Viesgo' ELSE 'i-DE' END AS distributor_network, count(*) AS n
           FROM friction GROUP BY 1, 2""",
        "friction",
    ),
)
def friction_by_network(spark, sf):
    from ...operators.ranking import value_counts

    return value_counts(network(spark, sf).friction_points, "grid_status", "distributor_network")


@query(
    "priority_stations",
    walk_sql(
        """SELECT round(x, 3) AS x, round(y, 3) AS y, route_segment, station_type FROM proposed
           WHERE grid_status = 'Sufficient'""",
        "proposed",
    ),
)
def priority_stations(spark, sf):
    out = N.priority_stations(network(spark, sf).proposed)
    return out.select(F.round("x", 3).alias("x"), F.round("y", 3).alias("y"), "route_segment", "station_type")


@query(
    "kpi_scorecard",
    walk_sql(
        f"""SELECT count(*) AS total_proposed_stations, (SELECT count(*) FROM stations) AS total_existing_stations_baseline,
                   count(CASE WHEN grid_status <> 'Sufficient' THEN 1 END) AS total_friction_points,
                   (SELECT {S.DEMAND_METRIC} FROM planning WHERE scenario = 'normal') AS total_ev_projected_2027
            FROM proposed""",
        "proposed",
        "stations",
        "planning",
    ),
)
def kpi_scorecard(spark, sf):
    plan = D.demand(spark, sf)
    return network(spark, sf, plan).scorecard(plan.planning_number)
