"""Cleaning steps shared by the sources."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import text
from ..functions.dates import parse_date
from .quality import require_columns


# --------------------------------------------------------------------------
# headers
# --------------------------------------------------------------------------
def strip_headers(df: DataFrame) -> DataFrame:
    """Trim column names and turn line breaks in them into spaces."""
    return df.toDF(*(c.replace("\n", " ").strip() for c in df.columns))


def unique_headers(names: Sequence[str]) -> list[str]:
    """Second and later repeats of a name get ``_1``, ``_2``, ..."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        count = seen.get(name, 0)
        out.append(f"{name}_{count}" if count else name)
        seen[name] = count + 1
    return out


def rename_present(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; others in the mapping are ignored."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def first_present(df: DataFrame, candidates: Sequence[str], default: str | None = None) -> Column:
    """The first candidate column the table has."""
    for name in candidates:
        if name in df.columns:
            return F.col(name)
    return F.lit(default).cast("string")


# --------------------------------------------------------------------------
# rows
# --------------------------------------------------------------------------
def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of the keys the table has."""
    present = [k for k in keys if k in df.columns]
    return df.na.drop(subset=present) if present else df


def has_coordinates(lat: Column, lon: Column) -> Column:
    """Both texts are there and not empty."""
    return lat.isNotNull() & (lat != "") & lon.isNotNull() & (lon != "")


def in_area(
    df: DataFrame,
    lat: str = "latitude",
    lon: str = "longitude",
    lat_range: tuple[float, float] = S.LATITUDE_RANGE,
    lon_range: tuple[float, float] = S.LONGITUDE_RANGE,
) -> DataFrame:
    """Rows inside the closed bounding box."""
    return df.where(F.col(lat).between(*lat_range) & F.col(lon).between(*lon_range))


def outside_cities(df: DataFrame, name: str = "name", cities: Sequence[str] = S.EXCLUDED_CITIES) -> DataFrame:
    """Drop rows whose name contains one of the city names (unaccented comparison)."""
    return df.where(~text.mentions_any(F.col(name), cities))


# --------------------------------------------------------------------------
# registrations
# --------------------------------------------------------------------------
def with_ev_flags(df: DataFrame, category: str = "ev_category") -> DataFrame:
    """Three-valued category flags; a null category leaves all of them null."""
    c = F.col(category)
    rechargeable = c.isin(*S.RECHARGEABLE_CATEGORIES)
    return df.withColumns(
        {
            "is_bev": c == "BEV",
            "is_phev": c == "PHEV",
            "is_reev": c == "REEV",
            "is_rechargeable_ev": rechargeable,
            "rechargeable_ev_type": F.when(rechargeable, c),
        }
    )


def with_forecast_bucket(df: DataFrame, kind: str = "rechargeable_ev_type") -> DataFrame:
    """Full electric against all other rechargeable vehicles; others get null."""
    c = F.col(kind)
    return df.withColumn("bucket", F.when(c == S.BEV, S.BEV).when(c.isNotNull(), S.OTHER))


# --------------------------------------------------------------------------
# road flows
# --------------------------------------------------------------------------
# fixed values: column names of the flow files
OD_NAMES = {
    "date": "date",
    "origen": "origin_zone",
    "destino": "destination_zone",
    "ruta": "route_id",
    "distancia": "distance_km",
    "viajes": "trips",
}
SEGMENT_NAMES = {
    "tramo": "segment_id",
    "total": "trips_total",
    "origen_principal": "main_origin",
    "destino_principal": "main_destination",
    "corto": "trips_short",
    "medio": "trips_medium",
    "largo": "trips_long",
    "intra_GAU": "trips_intra_gau",
    "inter_GAU": "trips_inter_gau",
    "intra_provincial": "trips_intra_provincial",
    "inter_provincial": "trips_inter_provincial",
    "intra_ccaa": "trips_intra_ccaa",
    "inter_ccaa": "trips_inter_ccaa",
    "nacional": "trips_national",
    "extranjero": "trips_foreign",
}


def _numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: text.to_double(F.col(c).cast("string")) for c in present})


def clean_od_routes(df: DataFrame) -> DataFrame:
    """Origin-destination routes: names, keys, numbers, date."""
    df = drop_null_keys(rename_present(df, OD_NAMES), ["origin_zone", "destination_zone", "route_id"])
    df = _numbers(df, ["distance_km", "trips"])
    if "date" in df.columns:
        df = df.withColumn("date", parse_date(F.col("date").cast("string"), "yyyyMMdd"))
    return df


def clean_segments(df: DataFrame) -> DataFrame:
    """Statistics per road segment: names, key, numbers."""
    df = drop_null_keys(rename_present(df, SEGMENT_NAMES), ["segment_id"])
    return _numbers(df, [c for c in SEGMENT_NAMES.values() if c.startswith("trips_")])


def clean_segment_routes(df: DataFrame) -> DataFrame:
    """Relation of segments and routes: keys, numbers."""
    return _numbers(drop_null_keys(df, ["origen", "destino", "ruta", "tramo"]), ["viajes"])


Cleaner = Callable[[DataFrame], DataFrame]

#: data set -> (separator, cleaner); add an entry to plug in another file kind
CLEANERS: dict[str, tuple[str, Cleaner]] = {
    "od_routes": ("|", clean_od_routes),
    "segments": (";", clean_segments),
    "segment_routes": ("|", clean_segment_routes),
}

# --------------------------------------------------------------------------
# substations
# --------------------------------------------------------------------------
SUBSTATION_COLUMNS = ["substation_id", "x", "y", "latitude", "longitude", "capacity_available_mw", "capacity_occupied_mw"]


def unify_substations(sources: Mapping[str, DataFrame]) -> DataFrame:
    """One table of all distributors: common columns and an operator tag; rows without position go."""
    whole: DataFrame | None = None
    for operator, df in sources.items():
        require_columns(df, ["capacity_available_mw", "capacity_occupied_mw"])
        part = df.select(*(c for c in SUBSTATION_COLUMNS if c in df.columns), F.lit(operator).alias("grid_operator"))
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    assert whole is not None, "no sources"
    return drop_null_keys(whole, ["latitude", "longitude", "x", "y"])


def tagged_union(parts: Mapping[str, DataFrame], tag: str = "tag") -> DataFrame:
    """Union by name with a column that names the part a row came from."""
    whole: DataFrame | None = None
    for name, df in parts.items():
        part = df.withColumn(tag, F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    assert whole is not None, "no parts"
    return whole
