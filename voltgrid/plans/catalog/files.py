"""Readers and writers: tables written out in each file format, read back, compared.

The files are written below the checkpoint folder, by all tasks, in the shapes the
readers meet in practice: several files, different headers, short rows, decimal commas,
gzip, latin-1, XML elements, GeoJSON features.
"""

import io
import uuid
import zipfile

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import geodesy as G
from ...functions.dates import file_name_date
from ...operators import cleaning as C
from ...session import ensure_checkpoint_dir
from ...sources import delimited, fixed_width, geojson, sinks, sites_xml
from .. import bindings as b
from ..registry import query, sql, view
from .cleaning import _line
from .flows import lonlat_sql


def _folder(spark, name: str) -> str:
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/files-{uuid.uuid4().hex}/{name}"


def _csv(df: DataFrame, path: str, sep: str, encoding: str = "UTF-8", mode: str = "error", **options) -> None:
    df.write.mode(mode).options(header="true", sep=sep, encoding=encoding, **options).csv(path)


def _spanish(c: str, digits: int = 6):
    """``1.234,500000``; null stays null."""
    return F.translate(F.format_number(F.col(c), digits), ",.", ".,")


# ---- substations: three distributors, two header orders each -----------------------
_READERS = {
    "Iberdrola i-DE": (delimited.read_iberdrola, "UTF-8", True),
    "Endesa e-distribución": (delimited.read_endesa, "UTF-8", True),
    "Viesgo": (delimited.read_viesgo, "ISO-8859-1", False),
}


@query(
    "substation_files",
    sql(
        """SELECT CAST(substation_id AS VARCHAR) AS substation_id, grid_operator, x, y,
                  round(capacity_available_mw, 6) AS capacity_available_mw, round(capacity_occupied_mw, 6) AS capacity_occupied_mw
           FROM subs""",
        "subs",
    ),
)
def substation_files(spark, sf):
    known = b.substations(spark, sf)
    sources = {}
    for tag, (reader, encoding, grouped) in _READERS.items():
        path = _folder(spark, "substations")
        capacity = _spanish if grouped else lambda c: F.replace(F.format_string("%.6f", F.col(c)), F.lit("."), F.lit(","))
        own = known.where(F.col("grid_operator") == tag).select(
            F.col("substation_id").cast("string").alias("Subestación"),
            F.lit("Añover").alias("Municipio"),
            _spanish("x").alias("Coordenada UTM X"),
            _spanish("y").alias("Coordenada UTM Y"),
            F.when(F.col("capacity_available_mw").isNotNull(), capacity("capacity_available_mw")).alias("Capacidad disponible (MW)"),
            capacity("capacity_occupied_mw").alias("Capacidad ocupada (MW)"),
        )
        even = F.col("Subestación").cast("long") % 2 == 0
        _csv(own.where(even), path, ";", encoding)
        _csv(own.where(~even).select(*own.columns[::-1]), path, ";", encoding, mode="append")
        sources[tag] = reader(spark, path)
    whole = C.unify_substations(sources)
    return whole.select(
        "substation_id", "grid_operator", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"),
        F.round("capacity_available_mw", 6).alias("capacity_available_mw"),
        F.round("capacity_occupied_mw", 6).alias("capacity_occupied_mw"),
    )


@query(
    "short_and_long_rows",
    """SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS brand, CASE WHEN p_partkey % 3 <> 1 THEN p_type END AS kind
       FROM part WHERE p_partkey % 3 <> 2""",
)
def short_and_long_rows(spark, sf):
    """Rows with a field too few are kept, rows with one too many are not."""
    path = _folder(spark, "rows")
    part = spark.read.parquet(f"{sf}/part.parquet")
    fields = [F.col("p_partkey").cast("string"), F.col("p_brand"), F.when(F.col("p_partkey") % 3 != 1, F.col("p_type"))]
    surplus = F.when(F.col("p_partkey") % 3 == 2, F.lit("surplus"))
    # one column named as the header line: the writer puts it on top of every file
    lines = part.select(F.concat_ws(";", *fields, surplus).alias("id;brand;kind"))
    lines.write.options(header="true", sep="\u0001", quote="").csv(path)
    return delimited.read_strings(spark, path, ["id", "brand", "kind"])


# ---- flows: gzip, many files, Parquet by date ---------------------------------------
def _raw_od(spark, sf) -> DataFrame:
    return b.od_routes(spark, sf).select(
        F.date_format("date", "yyyyMMdd").alias("date"),
        F.col("origin_zone").alias("origen"),
        F.col("destination_zone").alias("destino"),
        F.col("route_id").alias("ruta"),
        F.col("distance_km").cast("string").alias("distancia"),
        F.col("trips").cast("string").alias("viajes"),
    )


_BY_DAY = """SELECT date, count(*) AS n, count(DISTINCT origin_zone) AS origins, sum(trips) AS trips,
                    min(distance_km) AS shortest_km, max(distance_km) AS longest_km FROM od GROUP BY date"""


def _by_day(od: DataFrame) -> DataFrame:
    return od.groupBy("date").agg(
        F.count(F.lit(1)).cast("long").alias("n"),
        F.countDistinct("origin_zone").cast("long").alias("origins"),
        F.sum("trips").alias("trips"),
        F.min("distance_km").alias("shortest_km"),
        F.max("distance_km").alias("longest_km"),
    )


@query("gzip_flow_files", sql(_BY_DAY, "od"))
def gzip_flow_files(spark, sf):
    path = _folder(spark, "od")
    _csv(_raw_od(spark, sf), path, "|", compression="gzip")
    return _by_day(delimited.read_raw_flows(spark, path, "od_routes"))


@query("clean_flow_files", sql(_BY_DAY, "od"))
def clean_flow_files(spark, sf):
    path = _folder(spark, "clean")
    od = b.od_routes(spark, sf)
    columns = ["date", "origin_zone", "destination_zone", "route_id", "distance_km", "trips"]
    _csv(od.select(*columns).withColumn("date", F.date_format("date", "yyyy-MM-dd")), path, ",")
    return _by_day(delimited.read_clean_od(spark, path))


@query("flows_by_date", sql(_BY_DAY, "od"))
def flows_by_date(spark, sf):
    path = _folder(spark, "flows")
    sinks.write_flows(b.od_routes(spark, sf), path)
    return _by_day(sinks.read_parquet(spark, path))


#: rows that one task sorts and writes at a time
ROWS_PER_FILE = 500_000


def _named_files(df: DataFrame, stamp: str, path: str, suffix: str) -> None:
    """Files called by their value of ``stamp``, written by all tasks and moved together.

    The rows of a value are one file up to `ROWS_PER_FILE`; more are dealt to several
    folders, a file of that name in each.
    """
    spark = df.sparkSession
    sizes = df.groupBy(stamp).count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    folders = 1 + (sizes["most"] or 0) // ROWS_PER_FILE
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * (sizes["all"] or 0) // ROWS_PER_FILE)
    dealt = df.withColumn("folder", F.pmod(F.xxhash64(*df.columns), F.lit(folders)))
    dealt.repartition(tasks, stamp, "folder").write.mode("append").options(header="true", sep=";").partitionBy("folder", stamp).csv(f"{path}-parts")
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in fs.globStatus(Path(f"{path}-parts/folder=*/{stamp}=*/part-*")):
        named = part.getPath().getParent()
        value, folder = (p.getName().split("=", 1)[1] for p in (named, named.getParent()))
        fs.mkdirs(Path(f"{path}/{folder}"))
        fs.rename(part.getPath(), Path(f"{path}/{folder}/{value}{suffix}"))


@query(
    "files_by_header",
    """SELECT strftime(l_shipdate, '%Y%m') || '01 a+b%20.csv' AS source_file, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, count(*) AS n,
              CAST(sum(l_orderkey) AS BIGINT) AS orders, sum(CASE WHEN month(l_shipdate) % 3 <> 2 THEN l_quantity END) AS quantity,
              count(CASE WHEN month(l_shipdate) % 3 = 2 THEN l_linestatus END) AS noted
       FROM lineitem GROUP BY 1, 2""",
)
def files_by_header(spark, sf):
    """Files of a month each, in three header orders; where a row came from, and the date in the file's name."""
    path = _folder(spark, "headers")
    rows = spark.read.parquet(f"{sf}/lineitem.parquet").withColumn("stamp", F.date_format(F.trunc("l_shipdate", "MM"), "yyyyMMdd"))
    order, quantity, note = F.col("l_orderkey").alias("order"), F.col("l_quantity").alias("quantity"), F.col("l_linestatus").alias("note")
    for k, columns in enumerate([(order, quantity), (quantity, order), (note, order)]):
        _named_files(rows.where(F.month("l_shipdate") % 3 == k).select(*columns, "stamp"), "stamp", path, " a+b%20.csv")
    found = delimited.read_by_header(spark, f"{path}/*", source_file=True)
    return (
        found.withColumn("date", file_name_date(name="source_file"))
        .groupBy("source_file", "date")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("order").cast("long")).alias("orders"),
            F.sum(F.col("quantity").cast("double")).alias("quantity"),
            F.count("note").alias("noted"),
        )
    )


# ---- registrations: latin-1 text, months that are left alone --------------------------
@query(
    "fixed_width_files",
    f"""WITH raw AS (SELECT {_line("strftime(o_orderdate, '%d%m%Y')", 'VARCHAR')} AS line FROM orders),
        kept AS (SELECT line FROM raw WHERE length(line) >= 200 AND trim(substring(line, 94, 1)) IN ('3', 'H', 'I', 'K'))
        SELECT trim(substring(line, 94, 1)) AS propulsion_code, trim(substring(line, 153, 2)) AS province_code_vehicle,
               nullif(trim(substring(line, 454, 4)), '') AS ev_category, count(*) AS n FROM kept GROUP BY 1, 2, 3""",
)
def fixed_width_files(spark, sf):
    path = _folder(spark, "registrations")
    lines = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(f"{_line('''date_format(o_orderdate, 'ddMMyyyy')''', 'STRING')} AS value")
    lines.write.option("compression", "gzip").text(path)
    parsed = fixed_width.parse_registrations(fixed_width.read_lines(spark, path))
    return parsed.groupBy("propulsion_code", "province_code_vehicle", "ev_category").agg(F.count(F.lit(1)).cast("long").alias("n"))


def _archives(lines: DataFrame) -> DataFrame:
    """ZIP archives (``path``, ``content``) of each month's lines, one per batch of rows."""

    def pack(batches):
        for batch in batches:
            for stamp, rows in batch.groupby("stamp"):
                packed = io.BytesIO()
                with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
                    archive.writestr(f"export_{stamp}.txt", "\r\n".join(rows["value"]).encode("latin-1"))
                yield pd.DataFrame({"path": [f"/exports/export_{stamp}.zip"], "content": [packed.getvalue()]})

    return lines.mapInPandas(pack, "path string, content binary")


@query(
    "zipped_registrations",
    f"""WITH raw AS (SELECT {_line("strftime(o_orderdate, '%d%m%Y')", 'VARCHAR')} AS line, o_orderdate AS d FROM orders),
        kept AS (SELECT * FROM raw WHERE length(line) >= 200 AND trim(substring(line, 94, 1)) IN ('3', 'H', 'I', 'K'))
        SELECT CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month, trim(substring(line, 94, 1)) AS propulsion_code,
               nullif(trim(substring(line, 454, 4)), '') AS ev_category, count(*) AS n FROM kept GROUP BY ALL""",
)
def zipped_registrations(spark, sf):
    """Archives named by their month, the text inside in fixed widths."""
    lines = spark.read.parquet(f"{sf}/orders.parquet").selectExpr(
        f"{_line('date_format(o_orderdate, \"ddMMyyyy\")', 'STRING')} AS value", "date_format(o_orderdate, 'yyyyMM') AS stamp"
    )
    read = fixed_width.unzip_lines(_archives(lines))
    dated = fixed_width.with_file_month(fixed_width.parse_registrations(read))
    return dated.groupBy("year", "month", "propulsion_code", "ev_category").agg(F.count(F.lit(1)).alias("n"))


@query(
    "months_left_alone",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, count(*) AS n,
              CASE WHEN year(o_orderdate) < 1998 THEN 'first' ELSE 'second' END AS run FROM orders GROUP BY ALL""",
)
def months_left_alone(spark, sf):
    """A second run brings all months, and stores only those that are not there yet."""
    path = _folder(spark, "months")
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(
        "o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")
    )
    sinks.write_new_months(rows.where("year < 1998").withColumn("run", F.lit("first")), path)
    sinks.write_new_months(rows.withColumn("run", F.lit("second")), path)
    return sinks.read_parquet(spark, path).groupBy("year", "month", "run").agg(F.count(F.lit(1)).cast("long").alias("n"))


# ---- sites in XML ----------------------------------------------------------------------
#: an XML file is read as a whole by one task, so a publication of many sites comes in several files
SITES_PER_FILE = 20_000
view("sites_at", lonlat_sql("sites", "site_id, name, n_connectors, operator"), "sites")


@query(
    "site_xml_files",
    sql(
        """SELECT CAST(site_id AS VARCHAR) AS site_id, name, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude,
                  CAST(n_connectors AS INTEGER) AS n_connectors,
                  CASE WHEN n_connectors > 0 THEN CAST(n_connectors * 50 AS DOUBLE) END AS max_power_kw,
                  CASE WHEN n_connectors > 1 THEN 'ccs, type2' WHEN n_connectors = 1 THEN 'type2' END AS connector_types, operator
           FROM sites_at""",
        "sites_at",
    ),
)
def site_xml_files(spark, sf):
    path = _folder(spark, "sites")
    placed = G.with_lonlat(b.sites(spark, sf))
    connector = "named_struct('connectorType', if(k % 2 = 1, 'type2', 'ccs'), 'maxPowerOutput', CAST(k * 50000 AS STRING))"
    placed.selectExpr(
        "CAST(site_id AS STRING) AS _id",
        "named_struct('values', named_struct('value', name)) AS name",
        "named_struct('operatorName', operator) AS operator",
        "named_struct('coordinatesForDisplay', named_struct('latitude', CAST(latitude AS STRING), 'longitude', CAST(longitude AS STRING)))"
        " AS locationReference",
        "array(named_struct('refillPoint', transform(filter(sequence(0, cast(n_connectors AS int)), k -> k > 0),"
        f" k -> named_struct('energyInfrastructureConnector', array({connector}))))) AS energyInfrastructureStation",
    ).write.format("xml").options(rowTag=sites_xml.ROW_TAG, rootTag="energyInfrastructureTable", maxRecordsPerFile=SITES_PER_FILE).save(path)
    sites = sites_xml.read_sites(spark, path, boxed=False)
    return sites.withColumns({c: F.round(c, 6) for c in ("longitude", "latitude")}).withColumn("n_connectors", F.col("n_connectors").cast("int"))


# ---- roads as GeoJSON ---------------------------------------------------------------------
@query(
    "road_geojson_files",
    sql(
        """SELECT road_id, label, type, CAST(2 AS INTEGER) AS n_vertices, round(sqrt(pow(x2 - x1, 2) + pow(y2 - y1, 2)), 3) AS metres,
                  round(x1, 3) AS first_x FROM roads""",
        "roads",
    ),
)
def road_geojson_files(spark, sf):
    path = _folder(spark, "roads")
    b.roads(spark, sf).selectExpr(
        "'Feature' AS type",
        "named_struct('road_id', road_id, 'label', label, 'type', type) AS properties",
        "named_struct('type', 'LineString', 'coordinates', transform(vertices, v -> array(v.x, v.y))) AS geometry",
    ).write.json(path)
    lines = geojson.read_lines(spark, path, {"road_id": "long", "label": "string", "type": "string"}, project=False, per_line=True)
    return lines.selectExpr(
        "road_id", "label", "type", "size(vertices) AS n_vertices", f"round({G.line_length('vertices')}, 3) AS metres",
        "round(vertices[0].x, 3) AS first_x",
    )


# ---- result tables as CSV -----------------------------------------------------------------------
@query(
    "result_csv_files",
    "SELECT p_brand AS brand, count(*) AS n, round(avg(p_retailprice), 4) AS price FROM part GROUP BY 1",
)
def result_csv_files(spark, sf):
    path = _folder(spark, "results")
    part = spark.read.parquet(f"{sf}/part.parquet")
    table = part.groupBy(F.col("p_brand").alias("brand")).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("p_retailprice"), 4).alias("price"))
    sinks.write_result_csv({"brands": table}, path, single_file=True)
    return spark.read.option("header", "true").schema("brand string, n long, price double").csv(f"{path}/brands")
