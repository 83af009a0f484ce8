"""Where to expand, where to fill gaps, and whether the grid can carry it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import geodesy as G
from ..functions import scoring, text
from ..session import materialise
from . import spatial
from .quality import assert_no_rows
from .ranking import above_quantile, first_per_group, with_labels
from .thinning import greedy_thinning

#: order of proposals: expansions by site, then new stations by weight and origin
PROPOSAL_ORDER = ["type_rank", "weight_rank", "source_id", "step"]


# --------------------------------------------------------------------------
# roads and sites
# --------------------------------------------------------------------------
def main_roads(
    roads: DataFrame,
    label: str = "label",
    kinds: Sequence[str] = S.ROAD_TYPES,
    box: tuple[tuple[float, float], tuple[float, float]] | None = None,
) -> DataFrame:
    """Roads of the wanted types whose label starts with a weighted prefix, optionally inside a box."""
    chosen = roads.where(F.col("type").isin(*kinds) & text.starts_with_any(F.col(label), list(S.ROAD_WEIGHTS)))
    return chosen.where(G.line_meets_box("vertices", *box)) if box else chosen


def interurban_roads(roads: DataFrame, urban: DataFrame, radius: float = S.URBAN_BUFFER_M) -> DataFrame:
    """Roads that stay clear of the grown urban areas."""
    return spatial.lines_clear_of_polygons(roads, "road_id", "vertices", urban, radius=radius)


def interurban_sites(
    sites: DataFrame,
    roads: DataFrame,
    urban: DataFrame,
    road_radius: float = S.HIGHWAY_BUFFER_M,
    urban_radius: float = S.URBAN_BUFFER_M,
) -> DataFrame:
    """Sites near an interurban road and outside the grown urban areas."""
    segments = spatial.line_to_segments(roads, "vertices", ["road_id"])
    near = spatial.within_distance_of_lines(sites, segments, road_radius)
    return spatial.points_by_polygons(spatial.dealt(near), urban, radius=urban_radius, how="left_anti")


def snap_to_road(sites: DataFrame, roads: DataFrame, label: str = "label") -> DataFrame:
    """Label of the nearest road (lowest id on a tie); sites that find none get the unknown label."""
    segments = spatial.line_to_segments(roads.withColumnRenamed(label, "road_name"), "vertices", ["road_id", "road_name"])
    snapped = spatial.nearest(
        sites, segments, ["road_id", "road_name"], "road_id", geometry="segment", distance_col="road_distance_m"
    )
    return snapped.withColumn("road_name", F.coalesce("road_name", F.lit(S.UNKNOWN_ROAD)))


# --------------------------------------------------------------------------
# expand and fill
# --------------------------------------------------------------------------
def station_pressure(sites: DataFrame, growth: Column, name: str = "road_name") -> DataFrame:
    """Road weight, pressure score and segment label of existing stations."""
    return sites.withColumn("road_weight", scoring.road_weight(F.col(name), S.STATION_DEFAULT_WEIGHT)).withColumns(
        {
            "pressure_score": scoring.pressure_score(growth, F.col("road_weight"), F.col("n_connectors")),
            "route_segment": scoring.road_segment_label(F.col(name)),
        }
    )


def expand_stations(stations: DataFrame, share: float = S.EXPAND_SHARE) -> DataFrame:
    """The stations under most pressure; ties with the threshold stay in."""
    return above_quantile(stations, "pressure_score", share)


def road_candidates(roads: DataFrame, spacing: float = S.FILL_SPACING_M, label: str = "label") -> DataFrame:
    """Points along each road, both ends included.

    A road of length L gives ``max(1, floor(L / spacing)) + 1`` points, so one
    shorter than two spacings has only its ends.
    """
    sampled = (
        roads.where("size(vertices) > 0")
        .selectExpr("road_id", label, "vertices", f"{G.line_length('vertices')} AS _length")
        .selectExpr("*", f"cast(greatest(1, floor(_length / {spacing!r}D)) AS int) AS _steps")
        .selectExpr("*", "explode(sequence(0, _steps)) AS step")
    )
    name = F.coalesce(F.nullif(F.col(label), F.lit("")), F.lit(S.UNKNOWN_ROAD))
    return sampled.select(
        "road_id",
        "step",
        F.expr(G.point_along("vertices", "step / _steps")).alias("_p"),
        name.alias("road_name"),
    ).select(
        "road_id", "step", "_p.x", "_p.y", "road_name",
        scoring.road_weight(F.col("road_name"), S.CANDIDATE_DEFAULT_WEIGHT).alias("road_weight"),
    )


def clip_to_country(points: DataFrame, country: DataFrame) -> DataFrame:
    """Points inside the country."""
    return spatial.points_by_polygons(points, country, how="left_semi", cell=100_000.0)


def fill_candidates(
    candidates: DataFrame,
    country: DataFrame,
    urban: DataFrame,
    stations: DataFrame,
    exclusion: float = S.FILL_EXCLUSION_M,
    urban_radius: float = S.URBAN_BUFFER_M,
) -> DataFrame:
    """Candidates in the country, outside urban areas, and farther than ``exclusion`` from every station."""
    inside = clip_to_country(candidates, country)
    rural = materialise(spatial.points_by_polygons(inside, urban, radius=urban_radius, how="left_anti"))
    return spatial.farther_than(rural, stations, exclusion)


def thin_candidates(fill: DataFrame, spacing: float = S.FILL_SPACING_M) -> DataFrame:
    """Best-weighted candidates that keep the spacing among themselves."""
    return greedy_thinning(fill, spacing, ["road_weight", "road_id", "step"], descending=["road_weight"])


# --------------------------------------------------------------------------
# proposals
# --------------------------------------------------------------------------
def proposals(expand: DataFrame, fill: DataFrame) -> DataFrame:
    """Expansions and new stations in one table, with the columns that order them."""
    old = expand.selectExpr(
        "x", "y", "route_segment", "'EXPAND' AS station_type", "pressure_score",
        "0 AS type_rank", "0D AS weight_rank", "cast(site_id AS long) AS source_id", "0 AS step",
    )
    new = fill.withColumn("route_segment", scoring.road_segment_label(F.col("road_name"))).selectExpr(
        "x", "y", "route_segment", "'FILL' AS station_type", "0D AS pressure_score",
        "1 AS type_rank", "-road_weight AS weight_rank", "cast(road_id AS long) AS source_id", "step",
    )
    return old.unionByName(new)


def with_grid_status(proposed: DataFrame, substations: DataFrame) -> DataFrame:
    """Status by the nearest substation of known capacity, and the size of a station."""
    known = substations.where("capacity_available_mw IS NOT NULL").select("substation_id", "x", "y", "capacity_available_mw")
    joined = spatial.nearest(
        proposed, known, ["capacity_available_mw"], "substation_id", distance_col="dist_to_sub_m"
    )
    return joined.withColumns(
        {
            "grid_status": scoring.grid_status(F.col("capacity_available_mw")),
            "n_chargers_proposed": F.lit(S.CHARGERS_PER_STATION),
            "estimated_demand_kw": F.lit(S.DEMAND_KW),
        }
    )


def unique_places(proposed: DataFrame) -> DataFrame:
    """First proposal of each position in proposal order."""
    return first_per_group(proposed, ["x", "y"], [F.col(c) for c in PROPOSAL_ORDER])


def proposed_stations(proposed: DataFrame) -> DataFrame:
    """Result table of proposed stations with consecutive ids."""
    placed = G.with_lonlat(with_labels(proposed, PROPOSAL_ORDER, "IBE", "location_id"))
    return placed.select(
        "location_id", "latitude", "longitude", "route_segment", "n_chargers_proposed", "grid_status",
        "station_type", "pressure_score",
    )


def friction_points(proposed: DataFrame, substations: DataFrame) -> DataFrame:
    """Result table of places where the grid falls short, with the nearest network's name."""
    short = proposed.where(F.col("grid_status").isin("Moderate", "Congested"))
    numbered = with_labels(short, PROPOSAL_ORDER, "FRIC", "bottleneck_id")
    owners = substations.where("grid_operator IS NOT NULL").select("substation_id", "x", "y", "grid_operator")
    near = spatial.nearest(numbered, owners, ["grid_operator"], "substation_id", distance_col="_network_m")
    network = text.label_of(F.col("grid_operator"), S.DISTRIBUTOR_NAMES, S.DEFAULT_DISTRIBUTOR)
    placed = G.with_lonlat(near.withColumn("distributor_network", network)).select(
        "bottleneck_id", "latitude", "longitude", "route_segment", "n_chargers_proposed", "grid_status",
        "estimated_demand_kw", "distributor_network",
    )
    return assert_no_rows(placed, F.col("grid_status") == "Sufficient", "Sufficient place among friction points")


def priority_stations(proposed: DataFrame) -> DataFrame:
    """Proposals the grid can carry."""
    return proposed.where(F.col("grid_status") == "Sufficient")


def kpi_scorecard(proposed: DataFrame, baseline: DataFrame, projected: DataFrame) -> DataFrame:
    """One row: proposals, existing stations, friction points, projected vehicles."""
    existing = baseline.agg(F.count(F.lit(1)))
    return proposed.agg(
        F.count(F.lit(1)).cast("long").alias("total_proposed_stations"),
        F.count_if(F.col("grid_status") != "Sufficient").cast("long").alias("total_friction_points"),
    ).select(
        "total_proposed_stations",
        existing.scalar().cast("long").alias("total_existing_stations_baseline"),
        "total_friction_points",
        projected.scalar().cast("long").alias("total_ev_projected_2027"),
    )
