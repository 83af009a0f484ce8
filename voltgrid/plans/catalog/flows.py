"""Flows, provinces, densities, readiness, projection, ingest."""

import uuid

from pyspark.sql import functions as F

from ... import settings as S
from ...functions import geodesy as G
from ...functions.text import label_of
from ...operators import flows as FL
from ...operators import quality as Q
from ...operators import ranking as R
from ...operators import sketches as SK
from ...operators.tables import provinces as province_table
from ...session import ensure_checkpoint_dir
from ...sources import sinks
from ...streaming.ingest import ingest_months, read_months
from .. import bindings as b
from ..registry import query, sql, view
from .views import values

view("provinces", values(S.PROVINCES, ["code", "lat", "lon", "name"]))
view(
    "pairs",
    """SELECT left(origin_zone, 2) AS origin, left(destination_zone, 2) AS destination, sum(trips) AS trips
       FROM od WHERE left(origin_zone, 2) <> left(destination_zone, 2) GROUP BY 1, 2""",
    "od",
)
view("top_pairs", "SELECT * FROM pairs ORDER BY trips DESC, origin, destination LIMIT 40", "pairs")


@query(
    "od_top_flows",
    sql(
        """SELECT t.origin, t.destination, t.trips, round(t.trips / (SELECT max(trips) FROM top_pairs), 6) AS ratio,
                  o.lat AS origin_lat, o.lon AS origin_lon, o.name AS origin_name,
                  d.lat AS destination_lat, d.lon AS destination_lon, d.name AS destination_name
           FROM top_pairs t JOIN provinces o ON o.code = t.origin JOIN provinces d ON d.code = t.destination""",
        "top_pairs",
        "provinces",
    ),
)
def od_top_flows(spark, sf):
    flows = FL.province_flows(b.od_routes(spark, sf))
    return FL.top_flows(flows, b.provinces(spark)).withColumn("ratio", F.round("ratio", 6))


@query("od_matrix", sql("SELECT * FROM pairs", "pairs"))
def od_matrix(spark, sf):
    return FL.province_flows(b.od_routes(spark, sf))


view("outbound", "SELECT origin AS code, sum(trips) AS total_trips FROM pairs GROUP BY 1", "pairs")


@query(
    "province_outbound",
    sql(
        """SELECT p.*, o.total_trips, round(o.total_trips / max(o.total_trips) OVER (), 6) AS ratio
           FROM outbound o JOIN provinces p USING (code)""",
        "outbound",
        "provinces",
    ),
)
def province_outbound(spark, sf):
    out = FL.outbound_trips(FL.province_flows(b.od_routes(spark, sf)), b.provinces(spark))
    return out.withColumn("ratio", F.round("ratio", 6))


view(
    "by_province",
    """SELECT province_code AS code, count(propulsion_code) AS total_ev,
              count(CASE WHEN propulsion_code = '3' THEN 1 END) AS pure_bev,
              count(CASE WHEN propulsion_code IN ('H', 'I', 'K') THEN 1 END) AS phev
       FROM reg GROUP BY 1""",
    "reg",
)


@query(
    "registrations_by_province",
    sql(
        """SELECT p.*, r.total_ev, r.pure_bev, r.phev, round(r.total_ev / max(r.total_ev) OVER (), 6) AS ratio
           FROM by_province r JOIN provinces p USING (code)""",
        "by_province",
        "provinces",
    ),
)
def registrations_by_province(spark, sf):
    out = FL.registrations_by_province(b.registrations(spark, sf), b.provinces(spark))
    return out.withColumn("ratio", F.round("ratio", 6))


view("letters", values(list(S.PLATE_LETTERS.items()), ["number", "letter"]))


@query(
    "registrations_by_plate",
    sql(
        """SELECT l.letter AS code, p.lat, p.lon, p.name, r.total_ev, r.pure_bev, r.phev,
                  round(r.total_ev / max(r.total_ev) OVER (), 6) AS ratio
           FROM by_province r JOIN letters l ON l.number = r.code JOIN provinces p ON p.code = r.code""",
        "by_province",
        "letters",
        "provinces",
    ),
)
def registrations_by_plate(spark, sf):
    """Provinces coded by the letters of number plates; codes without letters are no province."""
    lettered = b.registrations(spark, sf).withColumn("province_code", label_of(F.col("province_code"), S.PLATE_LETTERS))
    out = FL.registrations_by_province(lettered, province_table(spark, key="letters"))
    return out.withColumn("ratio", F.round("ratio", 6))


view(
    "readiness",
    """SELECT substation_id, grid_operator, capacity_available_mw, capacity_occupied_mw,
              CASE WHEN coalesce(capacity_available_mw, 0) * 1000 >= 720 THEN 'Sufficient'
                   WHEN coalesce(capacity_available_mw, 0) * 1000 >= 480 THEN 'Moderate' ELSE 'Congested' END AS grid_status,
              CASE WHEN coalesce(capacity_available_mw, 0) + capacity_occupied_mw > 0
                   THEN capacity_occupied_mw / (coalesce(capacity_available_mw, 0) + capacity_occupied_mw) ELSE 0 END AS u
       FROM subs""",
    "subs",
)


@query(
    "substation_readiness",
    sql(
        """SELECT substation_id, grid_operator, capacity_available_mw, capacity_occupied_mw, grid_status,
                  round(u, 6) AS util, round(u * 100, 4) AS util_pct FROM readiness""",
        "readiness",
    ),
)
def substation_readiness(spark, sf):
    out = FL.substation_readiness(b.substations(spark, sf))
    return out.withColumns({"util": F.round("util", 6), "util_pct": F.round("util_pct", 4)})


@query(
    "grid_readiness_share",
    sql(
        """SELECT coalesce(grid_operator, 'ALL') AS grid_operator, count(*) AS substations,
                  count(CASE WHEN grid_status = 'Sufficient' THEN 1 END) AS ready,
                  round(count(CASE WHEN grid_status = 'Sufficient' THEN 1 END) / count(*), 6) AS ready_share
           FROM readiness GROUP BY ROLLUP (grid_operator)""",
        "readiness",
    ),
)
def grid_readiness_share(spark, sf):
    out = FL.readiness_share(FL.substation_readiness(b.substations(spark, sf)))
    return out.withColumn("ready_share", F.round("ready_share", 6))


@query(
    "charger_density",
    sql(
        """SELECT CAST(floor(x / 20000) AS BIGINT) AS cell_x, CAST(floor(y / 20000) AS BIGINT) AS cell_y, count(*) AS n
           FROM sites GROUP BY 1, 2""",
        "sites",
    ),
)
def charger_density(spark, sf):
    return FL.point_density(b.sites(spark, sf), "x", "y", 20_000.0)


# ---- projection: the same series written out for the check
def lonlat_sql(source: str, columns: str, x: str = "x", y: str = "y") -> str:
    p = G.UTM30
    k = p.scale * p.radius
    back = list(enumerate(p.from_plane, 1))
    xi0 = " - ".join(["xi", *(f"{c!r} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, c in back)])
    eta0 = " - ".join(["eta", *(f"{c!r} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, c in back)])
    lat = " + ".join(["chi", *(f"{c!r} * sin({2 * j} * chi)" for j, c in enumerate(p.to_latitude, 1))])
    return (
        f"SELECT {columns}, degrees(atan2(sinh(eta0), cos(xi0))) + ({p.central_meridian!r}) AS longitude,"
        f" degrees({lat}) AS latitude"
        f" FROM (SELECT *, asin(sin(xi0) / cosh(eta0)) AS chi"
        f" FROM (SELECT *, {xi0} AS xi0, {eta0} AS eta0"
        f" FROM (SELECT *, {y} / {k!r} AS xi, ({x} - {p.false_easting!r}) / {k!r} AS eta FROM {source})))"
    )


view("sites_lonlat", lonlat_sql("sites", "site_id, x, y"), "sites")


@query(
    "utm_to_lonlat",
    sql(
        """SELECT site_id, round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, x AS x_back, y AS y_back
           FROM sites_lonlat""",
        "sites_lonlat",
    ),
)
def utm_to_lonlat(spark, sf):
    there = G.with_lonlat(b.sites(spark, sf).select("site_id", "x", "y"))
    back = G.with_utm30(there, x="x_back", y="y_back")
    return back.select(
        "site_id",
        F.round("longitude", 6).alias("longitude"),
        F.round("latitude", 6).alias("latitude"),
        F.round("x_back", 3).alias("x_back"),
        F.round("y_back", 3).alias("y_back"),
    )


_CENTRE, _RADIUS = (40.0, -3.5), 150_000.0


@query(
    "points_in_radius",
    sql(
        f"""SELECT site_id, round(d, 3) AS distance_m FROM (
              SELECT site_id, {2 * G.EARTH_RADIUS_M!r} * asin(least(1, sqrt(
                pow(sin(radians({_CENTRE[0]} - latitude) / 2), 2) + cos(radians(latitude)) * cos(radians({_CENTRE[0]}))
                * pow(sin(radians({_CENTRE[1]} - longitude) / 2), 2)))) AS d
              FROM sites_lonlat) WHERE d <= {_RADIUS}""",
        "sites_lonlat",
    ),
)
def points_in_radius(spark, sf):
    placed = G.with_lonlat(b.sites(spark, sf).select("site_id", "x", "y"))
    near = FL.points_in_radius(placed, _CENTRE, _RADIUS)
    return near.select("site_id", F.round("distance_m", 3).alias("distance_m"))


@query(
    "seeded_sample",
    sql(f"SELECT * FROM sites ORDER BY md5('{S.SAMPLE_SEED}:' || CAST(site_id AS VARCHAR)), site_id LIMIT {S.SAMPLE_SIZE}", "sites"),
)
def seeded_sample(spark, sf):
    return R.seeded_sample(b.sites(spark, sf), ["site_id"])


# ---- connectors as lists per site ------------------------------------------------
@query(
    "site_connectors",
    sql(
        """SELECT site_id, n_connectors, CASE WHEN n_connectors > 0 THEN CAST(n_connectors * 22 AS DOUBLE) END AS max_power_kw,
                  CASE WHEN n_connectors > 2 THEN 'ccs, chademo, type2' WHEN n_connectors = 2 THEN 'ccs, chademo'
                       WHEN n_connectors = 1 THEN 'chademo' END AS connector_types FROM sites""",
        "sites",
    ),
)
def site_connectors(spark, sf):
    """Connectors come as lists, which hold the strongest anywhere and types more than once."""
    places = "filter(sequence(0, cast(n_connectors AS int)), k -> k > 0)"
    listed = b.sites(spark, sf).selectExpr(
        "site_id",
        f"transform(reverse({places}), k -> k * 22000D) AS powers",
        f"transform({places}, k -> element_at(array('type2', 'chademo', 'ccs'), k % 3 + 1)) AS types",
    )
    return FL.connector_summary(listed)


@query(
    "flow_profile_sketch",
    sql(
        """SELECT count(DISTINCT route_id) AS unique_routes, count(DISTINCT origin_zone || ' ' || destination_zone) AS unique_pairs,
                  true AS routes_close, true AS pairs_close FROM od""",
        "od",
    ),
)
def flow_profile_sketch(spark, sf):
    """Exact distinct counts, and whether those by sketch are within three times the stated error."""
    od = b.od_routes(spark, sf)
    exact, sketch = Q.flow_profile(od), Q.approx_flow_profile(od, error=0.02)
    both = exact.select("unique_routes", "unique_pairs", *[sketch.select(c).scalar().alias(f"s_{c}") for c in sketch.columns])
    close = lambda c: (F.abs(F.col(f"s_{c}") - F.col(c)) <= 0.06 * F.col(c))
    return both.select("unique_routes", "unique_pairs", close("unique_routes").alias("routes_close"), close("unique_pairs").alias("pairs_close"))


@query(
    "flow_profile_by_month",
    sql(
        """SELECT CAST(date_trunc('month', date) AS DATE) AS month, count(*) AS n_rows, sum(trips) AS total_trips,
                  round(avg(distance_km), 4) AS avg_distance_km, count(DISTINCT route_id) AS exact_routes,
                  count(DISTINCT origin_zone || ' ' || destination_zone) AS exact_pairs, true AS routes_close, true AS pairs_close
           FROM od GROUP BY 1""",
        "od",
    ),
)
def flow_profile_by_month(spark, sf):
    """Months out of stored days; the estimates lie within four standard errors of the exact counts."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/profiles-{uuid.uuid4().hex}"
    od = b.od_routes(spark, sf)
    sinks.write_parquet(SK.flow_sketches(od), path)
    merged = SK.merge_sketches(sinks.read_parquet(spark, path).withColumn("month", F.trunc("date", "MM")), ["month"])
    by_month = od.withColumn("month", F.trunc("date", "MM"))
    routes = by_month.select("month", "route_id").distinct().groupBy("month").agg(F.count("route_id").alias("exact_routes"))
    pairs = by_month.select("month", "origin_zone", "destination_zone").distinct().groupBy("month").agg(F.count("origin_zone").alias("exact_pairs"))

    def close(kind):
        gap = F.abs(F.col(f"unique_{kind}") - F.col(f"exact_{kind}"))
        return (gap <= 4 * SK.STANDARD_ERROR * F.col(f"exact_{kind}")).alias(f"{kind}_close")

    return merged.join(routes, "month").join(pairs, "month").select(
        "month", "n_rows", "total_trips", F.round("avg_distance_km", 4).alias("avg_distance_km"), "exact_routes", "exact_pairs",
        close("routes"), close("pairs"),
    )


@query(
    "incremental_ingest",
    """SELECT CAST(ts AS DATE) AS day, event_type, count(*) AS n, round(sum(value), 4) AS total
       FROM events GROUP BY 1, 2""",
)
def incremental_ingest(spark, sf):
    """File stream into a Parquet table by year and month, read back."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/ingest-{uuid.uuid4().hex}"
    schema = spark.read.parquet(f"{sf}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    ingest_months(
        stream,
        f"{folder}/table",
        f"{folder}/checkpoint",
        lambda df: df.withColumns({"year": F.year("ts"), "month": F.month("ts")}),
    )
    return (
        spark.read.parquet(f"{folder}/table")
        .groupBy(F.to_date("ts").alias("day"), "event_type")
        .agg(F.count(F.lit(1)).cast("long").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    )


@query(
    "ingest_in_parts",
    """SELECT CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT event_id) AS events, round(sum(value), 4) AS total
       FROM events GROUP BY 1""",
)
def ingest_in_parts(spark, sf):
    """Days over many files and batches, the same files again under a second checkpoint, and then stored days again."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/ingest-{uuid.uuid4().hex}"
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.repartition(12, "event_id").write.parquet(f"{folder}/in")

    def arrive(checkpoint, files, **how):
        stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/in")
        stream = stream.select("*", F.col("_metadata.file_name").alias("source_file"))
        by_day = lambda df: df.withColumn("day", F.to_date("ts"))
        ingest_months(stream, f"{folder}/table", f"{folder}/{checkpoint}", by_day, keys=["day"], **how)

    arrive("first", 5)
    arrive("second", 4)
    events.repartition(2).write.mode("append").parquet(f"{folder}/in")
    arrive("third", 100, skip_stored=True)
    return (
        read_months(spark, f"{folder}/table")
        .groupBy("day")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.countDistinct("event_id").alias("events"),
            F.round(F.sum("value"), 4).alias("total"),
        )
    )
