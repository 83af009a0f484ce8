"""Charging sites from XML publications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import in_area

ROW_TAG = "energyInfrastructureSite"


def read_sites(spark: SparkSession, path: str, boxed: bool = True) -> DataFrame:
    """One row per site element, whatever its namespace prefix and nesting.

    The XML reader splits files at the row tag.  Coordinates, names and
    connectors are looked for at each depth where publications put them.
    Sites without coordinates are dropped.
    """
    raw = (
        spark.read.format("xml")
        .option("rowTag", ROW_TAG)
        .option("ignoreNamespace", "true")
        .option("attributePrefix", "_")
        .schema(SITE_SCHEMA)
        .load(path)
    )
    return _typed(raw, boxed)


_TEXT = "struct<values: struct<value: array<string>>, value: array<string>>"
_CONNECTOR = "array<struct<connectorType: string, maxPowerOutput: string>>"
_COORDS = "struct<latitude: string, longitude: string>"
SITE_SCHEMA = f"""
    _id string,
    name {_TEXT},
    operator struct<operatorName: string, name: {_TEXT}>,
    operatorName string,
    latitude string,
    longitude string,
    coordinatesForDisplay {_COORDS},
    locationReference struct<latitude: string, longitude: string, coordinatesForDisplay: {_COORDS},
        pointByCoordinates: struct<pointCoordinates: {_COORDS}>>,
    energyInfrastructureConnector {_CONNECTOR},
    energyInfrastructureStation array<struct<
        energyInfrastructureConnector: {_CONNECTOR},
        refillPoint: array<struct<energyInfrastructureConnector: {_CONNECTOR}, connector: {_CONNECTOR}>>>>
"""


def _text(path: str) -> list[str]:
    return [f"{path}.values.value[0]", f"{path}.value[0]"]


def _typed(raw: DataFrame, boxed: bool) -> DataFrame:
    def first_of(paths: list[str]) -> str:
        return "coalesce(" + ", ".join(f"nullif(trim({p}), '')" for p in paths) + ")"

    places = [
        "{}",
        "coordinatesForDisplay.{}",
        "locationReference.{}",
        "locationReference.coordinatesForDisplay.{}",
        "locationReference.pointByCoordinates.pointCoordinates.{}",
    ]
    connectors = (
        "concat(coalesce(energyInfrastructureConnector, array()),"
        " flatten(transform(coalesce(energyInfrastructureStation, array()),"
        " s -> concat(coalesce(s.energyInfrastructureConnector, array()),"
        " flatten(transform(coalesce(s.refillPoint, array()), p ->"
        " concat(coalesce(p.energyInfrastructureConnector, array()), coalesce(p.connector, array()))))))))"
    )
    powers = "filter(transform(c, k -> try_cast(trim(k.maxPowerOutput) AS double)), p -> p IS NOT NULL)"
    types = "filter(transform(c, k -> nullif(trim(k.connectorType), '')), t -> t IS NOT NULL)"
    sites = raw.selectExpr(
        "coalesce(_id, '') AS site_id",
        f"coalesce({first_of(_text('name'))}, '') AS name",
        f"try_cast({first_of([p.format('latitude') for p in places])} AS double) AS latitude",
        f"try_cast({first_of([p.format('longitude') for p in places])} AS double) AS longitude",
        f"{first_of(['operatorName', 'operator.operatorName', *_text('operator.name')])} AS operator",
        f"{connectors} AS c",
    ).selectExpr(
        "site_id", "name", "latitude", "longitude",
        "size(c) AS n_connectors",
        f"array_max({powers}) / 1000 AS max_power_kw",
        f"if(size({types}) = 0, NULL, array_join(array_sort(array_distinct({types})), ', ')) AS connector_types",
        "operator",
    )
    placed = sites.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return in_area(placed) if boxed else placed
