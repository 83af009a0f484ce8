"""The domain tables as views over the test tables.

Each binding is a projection of whole tables; the SQL text is written so that
Spark and DuckDB both run it, which keeps query and check on the same input.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from ..operators.tables import provinces as province_table
from ..functions import geodesy as G

# calendar of the bound registrations
FIRST_MONTH = dt.date(1995, 1, 1)
LAST_MONTH = dt.date(2001, 7, 1)
TARGET_MONTH = dt.date(2006, 12, 1)
YEAR_SHIFT = 2001 - 2026  # the driver path starts in the year of the last observed month
FOCUS_YEAR = 2002
CV_INITIAL, CV_STEP, CV_HORIZON = 36, 6, 12

#: outline of the country, metres in zone 30 north
COUNTRY_RING = [
    (120_000.0, 3_990_000.0),
    (880_000.0, 4_020_000.0),
    (905_000.0, 4_500_000.0),
    (700_000.0, 4_795_000.0),
    (150_000.0, 4_810_000.0),
    (90_000.0, 4_300_000.0),
]

REGISTRATIONS = """
SELECT o_orderkey AS vehicle_id,
       CAST(o_orderdate AS DATE) AS registration_date,
       CASE substring(o_orderpriority, 1, 1)
            WHEN '1' THEN 'BEV' WHEN '2' THEN 'PHEV' WHEN '3' THEN 'REEV' END AS ev_category,
       CASE substring(o_orderpriority, 1, 1)
            WHEN '1' THEN '3' WHEN '2' THEN 'H' WHEN '3' THEN 'I' WHEN '4' THEN '1' ELSE '2' END AS propulsion_code,
       lpad(CAST(o_custkey % 52 + 1 AS {text}), 2, '0') AS province_code,
       o_orderstatus AS brand
FROM orders"""

OD_ROUTES = """
SELECT lpad(CAST(l_suppkey % 52 + 1 AS {text}), 2, '0') || '001' AS origin_zone,
       lpad(CAST(l_partkey % 52 + 1 AS {text}), 2, '0') || '001' AS destination_zone,
       CAST(l_orderkey AS {text}) AS route_id,
       l_extendedprice / 1000 AS distance_km,
       l_quantity AS trips,
       CAST(l_shipdate AS DATE) AS date
FROM lineitem"""

SITES = """
SELECT c_custkey AS site_id,
       c_name AS name,
       CAST(100000 + (c_custkey * 15485) % 480000 AS DOUBLE) AS x,
       CAST(4000000 + (c_custkey * 32452) % 800000 AS DOUBLE) AS y,
       c_custkey % 7 AS n_connectors,
       c_mktsegment AS operator
FROM customer"""

SUBSTATIONS = """
SELECT s_suppkey AS substation_id,
       CAST(100000 + (s_suppkey * 27449) % 800000 AS DOUBLE) AS x,
       CAST(4000000 + (s_suppkey * 31337) % 800000 AS DOUBLE) AS y,
       CASE WHEN s_suppkey % 11 <> 0 THEN s_acctbal / 10000 END AS capacity_available_mw,
       (s_suppkey % 50) / CAST(100 AS DOUBLE) AS capacity_occupied_mw,
       CASE s_suppkey % 3 WHEN 0 THEN 'Iberdrola i-DE' WHEN 1 THEN 'Endesa e-distribución'
                          ELSE 'Viesgo' END AS grid_operator
FROM supplier"""

ROADS = """
SELECT road_id, label, type, x1, y1,
       x1 + metres * CASE road_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 WHEN 2 THEN CAST(0.6 AS DOUBLE)
                                      ELSE CAST(-0.8 AS DOUBLE) END AS x2,
       y1 + metres * CASE road_id % 4 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN CAST(0.8 AS DOUBLE)
                                      ELSE CAST(0.6 AS DOUBLE) END AS y2
FROM (SELECT p_partkey AS road_id,
             CASE p_partkey % 5 WHEN 0 THEN 'AP-' WHEN 1 THEN 'A' WHEN 2 THEN 'E' WHEN 3 THEN 'N' END
                 || CAST(p_size AS {text}) AS label,
             CASE p_partkey % 3 WHEN 0 THEN 'Major Highway' WHEN 1 THEN 'Secondary Highway' ELSE 'Road' END AS type,
             CAST(100000 + (p_partkey * 7919) % 800000 AS DOUBLE) AS x1,
             CAST(4000000 + (p_partkey * 104729) % 800000 AS DOUBLE) AS y1,
             CAST(p_size AS DOUBLE) * 8000 AS metres
      FROM part) AS base"""

URBAN = """
SELECT n_nationkey AS area_id,
       CAST(150000 + (n_nationkey * 31337) % 700000 AS DOUBLE) AS cx,
       CAST(4050000 + (n_nationkey * 27449) % 700000 AS DOUBLE) AS cy
FROM nation"""

URBAN_HALF = 10_000.0


def _view(spark: SparkSession, sf_dir: str, sql: str, table: str) -> DataFrame:
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    inner = sql.format(text="STRING").replace(f"FROM {table}", "FROM {source}")
    return spark.sql(inner, source=source)


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, REGISTRATIONS, "orders")


def od_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, OD_ROUTES, "lineitem")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SITES, "customer")


def substations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(spark, sf_dir, SUBSTATIONS, "supplier")


def roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    ends = "array(named_struct('x', x1, 'y', y1), named_struct('x', x2, 'y', y2)) AS vertices"
    return _view(spark, sf_dir, ROADS, "part").selectExpr("road_id", "type", "label", ends)


def urban_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = f"{URBAN_HALF!r}D"
    corners = [("-", "-"), ("+", "-"), ("+", "+"), ("-", "+")]
    ring = ", ".join(f"named_struct('x', cx {a} {h}, 'y', cy {b} {h})" for a, b in corners)
    return _view(spark, sf_dir, URBAN, "nation").selectExpr(
        "area_id", f"{G.ring_edges(f'array(array({ring}))')} AS edges"
    )


def country(spark: SparkSession) -> DataFrame:
    ring = ", ".join(f"named_struct('x', {x!r}D, 'y', {y!r}D)" for x, y in COUNTRY_RING)
    return spark.sql(f"SELECT 'ESP' AS code, {G.ring_edges(f'array(array({ring}))')} AS edges")


def provinces(spark: SparkSession) -> DataFrame:
    return province_table(spark)
