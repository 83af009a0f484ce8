"""Parsing and cleaning over text rebuilt from the tables."""

from pyspark.sql import functions as F

from ... import settings as S
from ...functions import text
from ...functions.dates import parse_date
from ...operators import cleaning as C
from ...operators import ranking as R
from ...sources.fixed_width import parse_registrations
from .. import bindings as b
from ..registry import query, sql, view
from . import views  # noqa: F401

# ---- fixed-width lines written from orders, parsed back
_LINE = (
    "rpad(concat({date}, ' ', rpad('', 8, ' '), rpad(o_orderstatus, 30, ' '), rpad(o_orderpriority, 22, ' '),"
    " rpad('', 24, ' '), {code}, {cc}, rpad('', 53, ' '), {province}, rpad('', 11, ' '), '28001', {date}, 'N',"
    " rpad('', 18, ' '), rpad('TOWN', 30, ' '), {power}, rpad('', 214, ' '), '15.5', rpad('', 4, ' '), {category},"
    " '   *99'), {length}, ' ')"
)


def _line(date: str, text_type: str) -> str:
    code = (
        "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN '3' WHEN '2' THEN 'H' WHEN '3' THEN 'I'"
        " WHEN '4' THEN '1' ELSE '2' END"
    )
    category = "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'BEV ' WHEN '2' THEN 'PHEV' ELSE '    ' END"
    return _LINE.format(
        date=date,
        code=code,
        cc=f"lpad(CAST(o_custkey % 3000 AS {text_type}), 5, '*')",
        province=f"lpad(CAST(o_custkey % 52 + 1 AS {text_type}), 2, '0')",
        power=f"rpad(CAST(o_orderkey % 400 AS {text_type}), 7, ' ')",
        category=category,
        length="CASE WHEN o_orderkey % 10 = 9 THEN 150 ELSE 480 END",
    )


@query(
    "fixed_width_parse",
    f"""WITH raw AS (SELECT {_line("strftime(o_orderdate, '%d%m%Y')", 'VARCHAR')} AS line FROM orders),
        kept AS (SELECT line FROM raw WHERE length(line) >= 200 AND trim(substring(line, 94, 1)) IN ('3', 'H', 'I', 'K'))
        SELECT CAST(try_strptime(substring(line, 1, 8), '%d%m%Y') AS DATE) AS registration_date,
               trim(substring(line, 18, 30)) AS brand, trim(substring(line, 48, 22)) AS model,
               trim(substring(line, 94, 1)) AS propulsion_code,
               CASE trim(substring(line, 94, 1)) WHEN '3' THEN 'Electric' WHEN 'H' THEN 'Hybrid_rechargeable_gasoline'
                    WHEN 'I' THEN 'Hybrid_rechargeable_diesel' ELSE 'Hybrid_rechargeable_other' END AS propulsion,
               TRY_CAST(regexp_replace(trim(substring(line, 95, 5)), '\\*', '') AS DOUBLE) AS engine_cc,
               trim(substring(line, 153, 2)) AS province_code_vehicle,
               TRY_CAST(regexp_replace(trim(substring(line, 228, 7)), '\\*', '') AS DOUBLE) AS power_kw,
               TRY_CAST(trim(substring(line, 446, 4)) AS DOUBLE) AS consumption_wh_km,
               nullif(trim(substring(line, 454, 4)), '') AS ev_category,
               TRY_CAST(regexp_replace(trim(substring(line, 458, 6)), '\\*', '') AS DOUBLE) AS ev_range_km,
               nullif(trim(substring(line, 454, 4)), '') = 'BEV' AS is_bev
        FROM kept""",
)
def fixed_width_parse(spark, sf):
    lines = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        f"{_line('''date_format(o_orderdate, 'ddMMyyyy')''', 'STRING')} AS value"
    )
    parsed = C.with_ev_flags(parse_registrations(lines))
    return parsed.select(
        "registration_date", "brand", "model", "propulsion_code", "propulsion", "engine_cc", "province_code_vehicle",
        "power_kw", "consumption_wh_km", "ev_category", "ev_range_km", "is_bev",
    )


_NUMBER_TEXTS = [
    "concat(CAST(o_orderkey AS {t}), '.', lpad(CAST(o_custkey % 1000 AS {t}), 3, '0'), ',5') AS thousands",
    "concat(' ', CAST(o_custkey AS {t}), ',25 ') AS comma",
    "CASE o_orderkey % 4 WHEN 0 THEN '*12' WHEN 1 THEN '1*2*3' WHEN 2 THEN '' ELSE '7.5' END AS starred",
]


def _as(columns: list[str], t: str, **more: str) -> list[str]:
    return [c.format(t=t, **more) for c in columns]


def _listed(columns: list[str], **more: str) -> str:
    return ", ".join(_as(columns, "VARCHAR", **more))


@query(
    "spanish_numbers",
    f"""WITH t AS (SELECT o_orderkey, {_listed(_NUMBER_TEXTS)} FROM orders)
        SELECT o_orderkey AS id, TRY_CAST(replace(replace(thousands, '.', ''), ',', '.') AS DOUBLE) AS spanish,
               TRY_CAST(trim(replace(comma, ',', '.')) AS DOUBLE) AS decimal_comma,
               TRY_CAST(trim(replace(thousands, ',', '.')) AS DOUBLE) AS dots_kept,
               TRY_CAST(regexp_replace(starred, '\\*', '') AS DOUBLE) AS starred FROM t""",
)
def spanish_numbers(spark, sf):
    t = spark.read.parquet(f"{sf}/orders.parquet").selectExpr("o_orderkey AS id", *_as(_NUMBER_TEXTS, "STRING"))
    return t.select(
        "id",
        text.spanish_number(F.col("thousands")).alias("spanish"),
        text.decimal_comma_number(F.col("comma")).alias("decimal_comma"),
        text.decimal_comma_number(F.col("thousands")).alias("dots_kept"),
        text.starred_number(F.col("starred")).alias("starred"),
    )


@query(
    "propulsion_labels",
    sql(
        """SELECT propulsion_code, CASE propulsion_code WHEN '3' THEN 'Pure Electric' WHEN 'H' THEN 'PHEV Gasoline'
                  WHEN 'I' THEN 'PHEV Diesel' WHEN 'K' THEN 'PHEV Other' ELSE 'Other EV' END AS label, count(*) AS n
           FROM reg GROUP BY 1, 2""",
        "reg",
    ),
)
def propulsion_labels(spark, sf):
    labelled = b.registrations(spark, sf).withColumn(
        "label", text.label_of(F.col("propulsion_code"), S.EV_LABELS, "Other EV")
    )
    return R.value_counts(labelled, "propulsion_code", "label")


@query(
    "bucket_filter",
    sql(
        """SELECT vehicle_id, CASE WHEN ev_category = 'BEV' THEN 'BEV' WHEN ev_category IS NOT NULL
                  THEN 'OTHER_RECHARGEABLE' END AS bucket FROM reg
           WHERE NOT coalesce(ev_category = 'BEV', true)""",
        "reg",
    ),
)
def bucket_filter(spark, sf):
    flagged = C.with_forecast_bucket(C.with_ev_flags(b.registrations(spark, sf)))
    return flagged.where(~F.col("is_bev")).select("vehicle_id", "bucket")


# ---- flow files: raw columns as text, some keys missing
_RAW_OD = [
    "{date} AS date",
    "CASE WHEN l_suppkey % 13 <> 0 THEN lpad(CAST(l_suppkey % 52 + 1 AS {t}), 2, '0') END AS origen",
    "lpad(CAST(l_partkey % 52 + 1 AS {t}), 2, '0') AS destino",
    "CAST(l_orderkey AS {t}) AS ruta",
    "CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_partkey AS {t}) END AS distancia",
    "CAST(CAST(l_quantity AS INTEGER) AS {t}) AS viajes",
]


@query(
    "clean_od",
    f"""WITH raw AS (SELECT {_listed(_RAW_OD, date="strftime(l_shipdate, '%Y%m%d')")} FROM lineitem)
        SELECT CAST(try_strptime(date, '%Y%m%d') AS DATE) AS date, origen AS origin_zone, destino AS destination_zone,
               ruta AS route_id, TRY_CAST(distancia AS DOUBLE) AS distance_km, TRY_CAST(viajes AS DOUBLE) AS trips
        FROM raw WHERE origen IS NOT NULL AND destino IS NOT NULL AND ruta IS NOT NULL""",
)
def clean_od(spark, sf):
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        *_as(_RAW_OD, "STRING", date="date_format(l_shipdate, 'yyyyMMdd')")
    )
    return C.CLEANERS["od_routes"][1](raw)


_RAW_SEGMENT = [
    "CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey AS {t}) END AS tramo",
    "CAST(o_custkey AS {t}) AS total",
    "CAST(o_custkey % 52 AS {t}) AS origen_principal",
    "CASE WHEN o_orderkey % 5 = 0 THEN '-' ELSE CAST(o_custkey % 9 AS {t}) END AS corto",
]


@query(
    "clean_segments",
    f"""WITH raw AS (SELECT {_listed(_RAW_SEGMENT)} FROM orders)
        SELECT tramo AS segment_id, TRY_CAST(total AS DOUBLE) AS trips_total, origen_principal AS main_origin,
               TRY_CAST(corto AS DOUBLE) AS trips_short FROM raw WHERE tramo IS NOT NULL""",
)
def clean_segments(spark, sf):
    raw = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(*_as(_RAW_SEGMENT, "STRING"))
    return C.CLEANERS["segments"][1](raw)


@query(
    "clean_segment_routes",
    """SELECT CAST(l_suppkey AS VARCHAR) AS origen, CAST(l_partkey AS VARCHAR) AS destino,
              CAST(l_orderkey AS VARCHAR) AS ruta, nullif(l_returnflag, 'N') AS tramo,
              TRY_CAST(CASE WHEN l_linenumber = 7 THEN l_linestatus ELSE CAST(l_quantity AS VARCHAR) END AS DOUBLE) AS viajes
       FROM lineitem WHERE l_returnflag <> 'N'""",
)
def clean_segment_routes(spark, sf):
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "cast(l_suppkey AS string) AS origen", "cast(l_partkey AS string) AS destino",
        "cast(l_orderkey AS string) AS ruta", "nullif(l_returnflag, 'N') AS tramo",
        "if(l_linenumber = 7, l_linestatus, cast(l_quantity AS string)) AS viajes",  # some are no numbers
    )
    return C.CLEANERS["segment_routes"][1](raw)


@query(
    "parsed_dates",
    """SELECT o_orderkey AS id, CAST(try_strptime(CASE WHEN o_orderkey % 3 = 0 THEN '31022024'
              ELSE strftime(o_orderdate, '%d%m%Y') END, '%d%m%Y') AS DATE) AS d FROM orders""",
)
def parsed_dates(spark, sf):
    raw = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        "o_orderkey AS id", "if(o_orderkey % 3 = 0, '31022024', date_format(o_orderdate, 'ddMMyyyy')) AS t"
    )
    return raw.select("id", parse_date(F.col("t"), "ddMMyyyy").alias("d"))


# ---- sites: names, coordinates as text
_RAW_SITES = [
    "c_custkey AS site_id",
    "CASE c_custkey % 4 WHEN 0 THEN 'Parking Madrid Sur' WHEN 1 THEN 'Área Málaga'"
    " WHEN 2 THEN 'estación zaragoza' ELSE c_name END AS name",
    "CASE WHEN c_custkey % 19 = 0 THEN '' ELSE CAST(34 + c_custkey % 12 AS {t}) END AS lat",
    "CAST(c_custkey % 18 - 11 AS {t}) AS lon",
]


@query(
    "bbox_and_city_filter",
    f"""WITH raw AS (SELECT {_listed(_RAW_SITES)} FROM customer)
        SELECT site_id, name, CAST(lat AS DOUBLE) AS latitude, CAST(lon AS DOUBLE) AS longitude FROM raw
        WHERE lat <> '' AND lon <> '' AND TRY_CAST(lat AS DOUBLE) BETWEEN 35.0 AND 44.5
          AND TRY_CAST(lon AS DOUBLE) BETWEEN -9.5 AND 5.0
          AND NOT regexp_matches(upper(name), 'MADRID|BARCELONA|VALENCIA|SEVILLA|ZARAGOZA|BILBAO|MALAGA')""",
)
def bbox_and_city_filter(spark, sf):
    raw = spark.read.parquet(f"{sf}/customer.parquet").selectExpr(*_as(_RAW_SITES, "STRING"))
    placed = raw.where(C.has_coordinates(F.col("lat"), F.col("lon"))).select(
        "site_id", "name",
        text.to_double(F.col("lat")).alias("latitude"), text.to_double(F.col("lon")).alias("longitude"),
    )
    return C.outside_cities(C.in_area(placed))


view(
    "connectors",
    """SELECT o_custkey AS site_id, CAST(o_orderkey % 350 AS DOUBLE) * 1000 AS power, o_orderpriority AS type
       FROM orders""",
)


@query(
    "connector_rows",
    sql(
        """SELECT CAST(site_id AS VARCHAR) AS site_id, count(*) AS n_connectors, max(power) / 1000 AS max_power_kw,
                  array_to_string(list_sort(list(DISTINCT type)), ', ') AS connector_types
           FROM connectors GROUP BY site_id""",
        "connectors",
    ),
)
def connector_rows(spark, sf):
    # a site holds a handful of connectors; they arrive as rows and are gathered per site
    rows = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        "cast(o_custkey AS string) AS site_id", "cast(o_orderkey % 350 AS double) * 1000 AS power", "o_orderpriority AS type"
    )
    return rows.groupBy("site_id").agg(
        F.count(F.lit(1)).cast("long").alias("n_connectors"),
        (F.max("power") / 1000).alias("max_power_kw"),
        F.array_join(F.array_sort(F.collect_set("type")), ", ").alias("connector_types"),
    )


@query(
    "unified_substations",
    sql(
        """SELECT grid_operator, count(*) AS n, count(capacity_available_mw) AS known FROM subs GROUP BY grid_operator""",
        "subs",
    ),
)
def unified_substations(spark, sf):
    whole = b.substations(spark, sf)
    parts = {o: whole.where(F.col("grid_operator") == o).drop("grid_operator") for o in S.DISTRIBUTOR_NAMES}
    return (
        C.unify_substations(parts)
        .groupBy("grid_operator")
        .agg(F.count(F.lit(1)).cast("long").alias("n"), F.count("capacity_available_mw").cast("long").alias("known"))
    )


@query(
    "tagged_nodes",
    sql(
        """SELECT substation_id, capacity_available_mw, 'DEMAND' AS tag FROM subs WHERE grid_operator = 'Viesgo'
           UNION ALL SELECT substation_id, capacity_occupied_mw, 'GENERATION' FROM subs WHERE grid_operator = 'Viesgo'""",
        "subs",
    ),
)
def tagged_nodes(spark, sf):
    nodes = b.substations(spark, sf).where("grid_operator = 'Viesgo'")
    return C.tagged_union(
        {
            "DEMAND": nodes.select("substation_id", "capacity_available_mw"),
            "GENERATION": nodes.selectExpr("substation_id", "capacity_occupied_mw AS capacity_available_mw"),
        }
    )

