"""Province roll-ups, densities and map layers (their data)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import geodesy as G
from ..functions import scoring
from ..functions.text import code_prefix
from .ranking import ratio_to_max, top_k


def province_flows(od: DataFrame) -> DataFrame:
    """Trips between different provinces; rows without a zone are left out."""
    return (
        od.where("origin_zone IS NOT NULL AND destination_zone IS NOT NULL")
        .select(
            code_prefix(F.col("origin_zone")).alias("origin"),
            code_prefix(F.col("destination_zone")).alias("destination"),
            "trips",
        )
        .where("origin != destination")
        .groupBy("origin", "destination")
        .agg(F.coalesce(F.sum("trips"), F.lit(0.0)).alias("trips"))
    )


def top_flows(flows: DataFrame, provinces: DataFrame, k: int = S.TOP_FLOWS) -> DataFrame:
    """The largest province pairs with names and positions of both ends, and their share of the largest."""
    top = ratio_to_max(top_k(flows, k, "trips", ["origin", "destination"]), "trips", "ratio")

    def ends(role: str) -> DataFrame:
        names = {"code": role, "name": f"{role}_name", "lat": f"{role}_lat", "lon": f"{role}_lon"}
        return F.broadcast(provinces.withColumnsRenamed(names))

    return top.join(ends("origin"), "origin").join(ends("destination"), "destination")


def outbound_trips(flows: DataFrame, provinces: DataFrame) -> DataFrame:
    """Outbound trips per known province and their share of the largest."""
    out = flows.groupBy(F.col("origin").alias("code")).agg(F.sum("trips").alias("total_trips"))
    return ratio_to_max(out.join(F.broadcast(provinces), "code"), "total_trips", "ratio")


def registrations_by_province(
    df: DataFrame,
    provinces: DataFrame,
    code: str = "province_code",
    propulsion: str = "propulsion_code",
    pure: Sequence[str] = (S.PURE_ELECTRIC_CODE,),
    plug_in: Sequence[str] = S.PLUG_IN_CODES,
) -> DataFrame:
    """Vehicles, pure electric and plug-in per known province, and the share of the largest."""
    c = F.col(propulsion)
    counted = (
        df.where(F.col(code).isNotNull())
        .groupBy(F.col(code).alias("code"))
        .agg(
            F.count(c).cast("long").alias("total_ev"),
            F.count_if(c.isin(*pure)).cast("long").alias("pure_bev"),
            F.count_if(c.isin(*plug_in)).cast("long").alias("phev"),
        )
    )
    return ratio_to_max(counted.join(F.broadcast(provinces), "code"), "total_ev", "ratio").orderBy(
        F.col("total_ev").desc(), "code"
    )


def point_density(df: DataFrame, x: str, y: str, cell: float) -> DataFrame:
    """Points per square cell: the data of a heat layer."""
    return df.groupBy(
        F.expr(f"cast(floor({x} / {float(cell)!r}D) AS long) AS cell_x"),
        F.expr(f"cast(floor({y} / {float(cell)!r}D) AS long) AS cell_y"),
    ).agg(F.count(F.lit(1)).cast("long").alias("n"))


def points_in_radius(
    df: DataFrame,
    centre: tuple[float, float] = S.CITY_CENTRE,
    radius: float = S.CITY_RADIUS_M,
    lat: str = "latitude",
    lon: str = "longitude",
) -> DataFrame:
    """Points not farther than ``radius`` metres from a centre ``(latitude, longitude)``."""
    d = G.haversine_m(lat, lon, f"{centre[0]!r}D", f"({centre[1]!r}D)")
    return df.selectExpr("*", f"{d} AS distance_m").where(F.col("distance_m") <= radius)


def substation_readiness(substations: DataFrame) -> DataFrame:
    """Status and utilisation of every substation."""
    free, used = F.col("capacity_available_mw"), F.col("capacity_occupied_mw")
    share = scoring.utilisation(free, used)
    return substations.select(
        "substation_id", "grid_operator", "capacity_available_mw", "capacity_occupied_mw",
        scoring.grid_status(free).alias("grid_status"),
        share.alias("util"),
        (share * 100).alias("util_pct"),
    )


def readiness_share(readiness: DataFrame) -> DataFrame:
    """Substations, the ready ones, and their share per operator and overall."""
    ready = F.count_if(F.col("grid_status") == "Sufficient")
    grouped = readiness.rollup("grid_operator").agg(
        F.count(F.lit(1)).cast("long").alias("substations"),
        ready.cast("long").alias("ready"),
        (ready / F.count(F.lit(1))).alias("ready_share"),
        F.grouping("grid_operator").alias("_all"),
    )
    return grouped.select(
        F.when(F.col("_all") == 1, "ALL").otherwise(F.col("grid_operator")).alias("grid_operator"),
        "substations", "ready", "ready_share",
    )


def connector_summary(sites: DataFrame) -> DataFrame:
    """Number of connectors, highest power in kW and distinct sorted types from lists per site."""
    return sites.selectExpr(
        "site_id",
        "cast(size(powers) AS long) AS n_connectors",
        "array_max(powers) / 1000 AS max_power_kw",
        "if(size(types) = 0, NULL, array_join(array_sort(array_distinct(types)), ', ')) AS connector_types",
    )
