"""GeoJSON features as rows.

A feature collection is one JSON document, which one task has to read.  Large
data should come as one feature per line (``per_line``); such files split.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geodesy as G


def _features(spark: SparkSession, path: str, properties: Mapping[str, str], per_line: bool) -> DataFrame:
    """One row per feature: number, kind, coordinates as text, properties (prefixed ``p_``)."""
    fields = ", ".join(f"`{n}`: {t}" for n, t in properties.items())
    parts = f"properties struct<{fields}>, geometry struct<type: string, coordinates: string>"
    if per_line:
        rows = spark.read.schema(parts).json(path).where("geometry IS NOT NULL")
        rows = rows.select(F.monotonically_increasing_id().alias("feature"), "properties", "geometry")
    else:
        nested = parts.replace("properties struct", "properties: struct").replace("geometry struct", "geometry: struct")
        docs = spark.read.schema(f"features array<struct<{nested}>>").option("multiLine", "true").json(path)
        # positions repeat from file to file, so features are numbered over all of them
        rows = docs.select(F.explode("features")).selectExpr(
            "monotonically_increasing_id() AS feature", "col.properties AS properties", "col.geometry AS geometry"
        )
    return rows.selectExpr(
        "feature", "geometry.type AS _kind", "geometry.coordinates AS _text",
        *(f"properties.`{n}` AS `p_{n}`" for n in properties),
    )


def _parts(rows: DataFrame, properties: Mapping[str, str], parts: str, project: bool) -> DataFrame:
    """One row per part (line or ring) with ``vertices``."""
    opened = rows.selectExpr("feature", *(f"`p_{n}` AS `{n}`" for n in properties), f"posexplode({parts}) AS (part, _line)")
    flat = opened.selectExpr(
        "feature", "part", *(f"`{n}`" for n in properties),
        "transform(_line, v -> named_struct('x', v[0], 'y', v[1])) AS vertices",
    )
    return _project(flat, ["feature", "part"]) if project else flat


def read_points(
    spark: SparkSession, path: str, properties: Mapping[str, str], per_line: bool = False
) -> DataFrame:
    """Point features: the properties, ``longitude`` and ``latitude``."""
    point = "from_json(_text, 'array<double>')"
    return (
        _features(spark, path, properties, per_line)
        .where("_kind = 'Point'")
        .selectExpr(
            *(f"`p_{n}` AS `{n}`" for n in properties), f"{point}[0] AS longitude", f"{point}[1] AS latitude"
        )
    )


def read_lines(
    spark: SparkSession, path: str, properties: Mapping[str, str], project: bool = True, per_line: bool = False
) -> DataFrame:
    """Line and multi-line features: one row per part with ``vertices`` (metres unless ``project`` is off)."""
    parts = (
        "CASE _kind WHEN 'LineString' THEN array(from_json(_text, 'array<array<double>>'))"
        " WHEN 'MultiLineString' THEN from_json(_text, 'array<array<array<double>>>') END"
    )
    return _parts(_features(spark, path, properties, per_line), properties, parts, project)


def read_polygons(
    spark: SparkSession, path: str, properties: Mapping[str, str], project: bool = True, per_line: bool = False
) -> DataFrame:
    """Polygon and multi-polygon features: one row per feature with ``edges`` of all rings."""
    rings = (
        "CASE _kind WHEN 'Polygon' THEN from_json(_text, 'array<array<array<double>>>')"
        " WHEN 'MultiPolygon' THEN flatten(from_json(_text, 'array<array<array<array<double>>>>')) END"
    )
    flat = _parts(_features(spark, path, properties, per_line), properties, rings, project)
    grouped = flat.groupBy("feature").agg(
        *(F.first(n).alias(n) for n in properties), F.collect_list("vertices").alias("rings")
    )
    return grouped.selectExpr("feature", *(f"`{n}`" for n in properties), f"{G.ring_edges('rings')} AS edges")


def _project(df: DataFrame, keys: list[str]) -> DataFrame:
    """Vertices from degrees to metres in zone 30 north."""
    other = [c for c in df.columns if c not in (*keys, "vertices")]
    opened = df.selectExpr(*keys, *(f"`{c}`" for c in other), "posexplode(vertices) AS (_i, _v)").selectExpr(
        *keys, *(f"`{c}`" for c in other), "_i", "_v.x AS _lon", "_v.y AS _lat"
    )
    placed = G.with_utm30(opened, "_lon", "_lat", "_x", "_y")
    return (
        placed.groupBy(*keys)
        .agg(*(F.first(c).alias(c) for c in other), F.expr("sort_array(collect_list(struct(_i, _x, _y))) AS _vs"))
        .selectExpr(*keys, *(f"`{c}`" for c in other), "transform(_vs, v -> named_struct('x', v._x, 'y', v._y)) AS vertices")
    )
