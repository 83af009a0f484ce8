"""Monthly series, counts, audits and profiles."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ... import settings as S
from ...operators import quality as Q
from ...operators import ranking as R
from ...operators import series as SE
from ...operators.cleaning import clean_segments, tagged_union, with_ev_flags, with_forecast_bucket
from ...session import ensure_checkpoint_dir
from .. import bindings as b
from ..registry import query, sql, view
from . import views  # noqa: F401

START, END = f"DATE '{b.FIRST_MONTH}'", f"DATE '{b.LAST_MONTH}'"

view("calendar", f"SELECT CAST(unnest(generate_series({START}, {END}, INTERVAL 1 MONTH)) AS DATE) AS month")
view(
    "by_bucket",
    """SELECT CAST(date_trunc('month', registration_date) AS DATE) AS month,
              CASE WHEN ev_category = 'BEV' THEN 'BEV' ELSE 'OTHER_RECHARGEABLE' END AS bucket, count(*) AS n
       FROM reg WHERE ev_category IN ('BEV', 'PHEV', 'REEV') GROUP BY 1, 2""",
    "reg",
)
view(
    "market",
    """SELECT CAST(date_trunc('month', registration_date) AS DATE) AS month, count(*) AS TOTAL_ALL_CARS,
              count(CASE WHEN ev_category IN ('BEV', 'PHEV', 'REEV') THEN 1 END) AS ELECTRIFIED_TOTAL
       FROM reg GROUP BY 1""",
    "reg",
)
view(
    "wide0",
    """SELECT c.month, coalesce(v.n, 0) AS BEV, coalesce(o.n, 0) AS OTHER_RECHARGEABLE,
              coalesce(m.TOTAL_ALL_CARS, 0) AS TOTAL_ALL_CARS, coalesce(m.ELECTRIFIED_TOTAL, 0) AS ELECTRIFIED_TOTAL
       FROM calendar c
       LEFT JOIN by_bucket v ON v.month = c.month AND v.bucket = 'BEV'
       LEFT JOIN by_bucket o ON o.month = c.month AND o.bucket = 'OTHER_RECHARGEABLE'
       LEFT JOIN market m ON m.month = c.month""",
    "calendar",
    "by_bucket",
    "market",
)
view(
    "wide",
    """SELECT *, greatest(TOTAL_ALL_CARS - ELECTRIFIED_TOTAL, 0) AS NORMAL_CARS,
              BEV + OTHER_RECHARGEABLE AS TOTAL_RECHARGEABLE FROM wide0""",
    "wide0",
)


def flagged(spark, sf):
    return with_forecast_bucket(with_ev_flags(b.registrations(spark, sf)))


@query("monthly_series_wide", sql("SELECT * FROM wide", "wide"))
def monthly_series_wide(spark, sf):
    return SE.monthly_series(flagged(spark, sf), b.FIRST_MONTH, b.LAST_MONTH)


@query(
    "monthly_pivot",
    sql(
        """SELECT month, CAST(coalesce(sum(CASE WHEN bucket = 'BEV' THEN n END), 0) AS BIGINT) AS BEV,
                  CAST(coalesce(sum(CASE WHEN bucket <> 'BEV' THEN n END), 0) AS BIGINT) AS OTHER_RECHARGEABLE
           FROM by_bucket GROUP BY month""",
        "by_bucket",
    ),
)
def monthly_pivot(spark, sf):
    return SE.pivot_counts(
        SE.monthly_by_bucket(flagged(spark, sf)), "month", "bucket", "n_vehicles", S.TARGET_SERIES
    )


@query(
    "monthly_market_totals",
    sql("SELECT *, TOTAL_ALL_CARS - ELECTRIFIED_TOTAL AS NORMAL_CARS FROM market", "market"),
)
def monthly_market_totals(spark, sf):
    return SE.monthly_market_totals(flagged(spark, sf))


view(
    "started",
    """SELECT month, series, CAST(y AS DOUBLE) AS y FROM (
         SELECT month, 'BEV' AS series, BEV AS y FROM wide WHERE TOTAL_RECHARGEABLE > 0
         UNION ALL SELECT month, 'OTHER_RECHARGEABLE', OTHER_RECHARGEABLE FROM wide WHERE TOTAL_RECHARGEABLE > 0
         UNION ALL SELECT month, 'TOTAL_RECHARGEABLE', TOTAL_RECHARGEABLE FROM wide WHERE TOTAL_RECHARGEABLE > 0) AS u""",
    "wide",
)


@query(
    "growth_index",
    sql(
        """SELECT month, series,
                  round(y / greatest(first_value(y) OVER (PARTITION BY series ORDER BY month), 1) * 100, 6) AS growth_index
           FROM started""",
        "started",
    ),
)
def growth_index(spark, sf):
    wide = monthly_series_wide(spark, sf)
    return SE.growth_index(wide).withColumn("growth_index", F.round("growth_index", 6))


@query(
    "category_breakdown",
    sql(
        """SELECT ev_category AS rechargeable_ev_type, count(*) AS n FROM reg
           WHERE ev_category IN ('BEV', 'PHEV', 'REEV') GROUP BY 1""",
        "reg",
    ),
)
def category_breakdown(spark, sf):
    return SE.category_breakdown(flagged(spark, sf))


@query(
    "overall_counts",
    sql(
        """SELECT 'total_records' AS metric, count(*) AS value FROM reg
           UNION ALL SELECT 'rechargeable_ev_bev_phev_reev', count(*) FROM reg WHERE ev_category IS NOT NULL
           UNION ALL SELECT 'battery_electric_vehicles_bev', count(*) FROM reg WHERE ev_category = 'BEV'
           UNION ALL SELECT 'plug_in_hybrid_phev', count(*) FROM reg WHERE ev_category = 'PHEV'
           UNION ALL SELECT 'range_extended_reev', count(*) FROM reg WHERE ev_category = 'REEV'""",
        "reg",
    ),
)
def overall_counts(spark, sf):
    return SE.overall_counts(flagged(spark, sf))


@query(
    "top_brands",
    sql("SELECT brand, count(*) AS n FROM reg GROUP BY brand ORDER BY n DESC, brand LIMIT 10", "reg"),
)
def top_brands(spark, sf):
    return R.value_counts(b.registrations(spark, sf), "brand", k=10)


@query(
    "gap_audit",
    sql(
        """SELECT min(m.month) AS first_month, max(m.month) AS last_month, count(*) AS months_expected,
                  count(m.month) AS months_present, count(*) - count(m.month) AS months_missing,
                  count(*) = count(m.month) AS is_gap_free
           FROM calendar c LEFT JOIN market m ON m.month = c.month""",
        "calendar",
        "market",
    ),
)
def gap_audit(spark, sf):
    months = SE.monthly_market_totals(flagged(spark, sf))
    return Q.month_coverage(months, SE.month_calendar(spark, b.FIRST_MONTH, b.LAST_MONTH))


view(
    "day_gaps",
    """SELECT series, month - lag(month) OVER (PARTITION BY series ORDER BY month) AS gap FROM started""",
    "started",
)


@query(
    "month_gaps",
    sql(
        """SELECT series, count(DISTINCT gap) AS distinct_gaps, CAST(max(gap) AS BIGINT) AS longest_gap_days,
                  count(DISTINCT gap) <= 4 AS is_monthly FROM day_gaps GROUP BY series""",
        "day_gaps",
    ),
)
def month_gaps(spark, sf):
    wide = monthly_series_wide(spark, sf)
    return SE.month_gaps(SE.to_long(wide.where(f"{S.TOTAL} > 0"), [S.BEV, S.OTHER, S.TOTAL]))


@query(
    "missing_months",
    sql(
        f"""SELECT CAST(d AS DATE) AS month
            FROM generate_series({START}, DATE '{b.TARGET_MONTH}', INTERVAL 1 MONTH) AS g(d)
            WHERE CAST(d AS DATE) NOT IN (SELECT month FROM market)""",
        "market",
    ),
)
def missing_months(spark, sf):
    months = SE.monthly_market_totals(flagged(spark, sf))
    return Q.missing_months(months, SE.month_calendar(spark, b.FIRST_MONTH, b.TARGET_MONTH))


@query(
    "dataset_profile",
    sql(
        """SELECT sum(trips) AS total_trips, count(DISTINCT route_id) AS unique_routes,
                  (SELECT count(*) FROM (SELECT DISTINCT origin_zone, destination_zone FROM od)) AS unique_pairs,
                  round(avg(distance_km), 4) AS avg_distance_km, min(date) AS first_date, max(date) AS last_date
           FROM od""",
        "od",
    ),
)
def dataset_profile(spark, sf):
    return Q.flow_profile(b.od_routes(spark, sf)).withColumn("avg_distance_km", F.round("avg_distance_km", 4))


@query(
    "segment_profile",
    """SELECT count(DISTINCT l_partkey) AS unique_segments, round(avg(l_quantity), 6) AS avg_trips_per_segment
       FROM lineitem""",
)
def segment_profile(spark, sf):
    raw = spark.read.parquet(f"{sf}/lineitem.parquet").selectExpr(
        "cast(l_partkey AS string) AS tramo", "cast(l_quantity AS string) AS total"
    )
    return Q.segment_profile(clean_segments(raw)).withColumn(
        "avg_trips_per_segment", F.round("avg_trips_per_segment", 6)
    )


@query(
    "null_profile",
    sql(
        """SELECT 'registration_date' AS "column", count(*) - count(registration_date) AS null_count FROM reg
           UNION ALL SELECT 'ev_category', count(*) - count(ev_category) FROM reg
           UNION ALL SELECT 'propulsion_code', count(*) - count(propulsion_code) FROM reg
           UNION ALL SELECT 'province_code', count(*) - count(province_code) FROM reg""",
        "reg",
    ),
)
def null_profile(spark, sf):
    columns = ["registration_date", "ev_category", "propulsion_code", "province_code"]
    return Q.null_counts(b.registrations(spark, sf), columns)


@query(
    "series_statistics",
    sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS "count", CAST(0 AS BIGINT) AS null_count,
                round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                CAST(min({c}) AS DOUBLE) AS "min", quantile_cont(CAST({c} AS DOUBLE), 0.25) AS p25,
                quantile_cont(CAST({c} AS DOUBLE), 0.5) AS p50, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS p75,
                CAST(max({c}) AS DOUBLE) AS "max" FROM wide"""
            for c in SE.WIDE_SERIES
        ),
        "wide",
    ),
)
def series_statistics(spark, sf):
    stats = Q.summary_statistics(monthly_series_wide(spark, sf), SE.WIDE_SERIES)
    return stats.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    "series_preview",
    sql(
        """SELECT 'first' AS part, month, TOTAL_ALL_CARS FROM (SELECT * FROM wide ORDER BY month LIMIT 6)
           UNION ALL SELECT 'last', month, TOTAL_ALL_CARS FROM (SELECT * FROM wide ORDER BY month DESC LIMIT 6)""",
        "wide",
    ),
)
def series_preview(spark, sf):
    wide = monthly_series_wide(spark, sf).select("month", "TOTAL_ALL_CARS")
    return tagged_union({"first": R.head(wide, 6, ["month"]), "last": R.tail(wide, 6, ["month"])}, "part").select("part", "month", "TOTAL_ALL_CARS")


@query(
    "dataset_gate",
    """SELECT true AS is_valid, 'ok' AS reason, count(*) AS row_count, '' AS missing_columns FROM orders""",
)
def dataset_gate(spark, sf):
    return Q.dataset_gate(spark, f"{sf}/orders.parquet", ["o_orderkey", "o_orderdate"])


@query(
    "gate_branches",
    """SELECT 'damaged' AS kind, false AS is_valid, 'read_failed' AS reason, CAST(0 AS BIGINT) AS row_count, '' AS missing_columns
       UNION ALL SELECT 'empty', count(*) > 0, 'empty_table', count(*), '' FROM orders WHERE o_orderkey < 0
       UNION ALL SELECT 'lacking', false, 'missing_columns', 0, 'absent,other'
       UNION ALL SELECT 'none', false, 'file_missing', 0, ''
       UNION ALL SELECT 'whole', true, 'ok', count(*), '' FROM orders""",
)
def gate_branches(spark, sf):
    """The gate's answers: whole, empty, columns missing, no file, files that are no Parquet."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/gates-{uuid.uuid4().hex}"
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    orders.where("o_orderkey < 0").write.parquet(f"{folder}/empty")
    orders.select(F.col("o_orderpriority").alias("value")).write.text(f"{folder}/damaged")
    whole, need = f"{sf}/orders.parquet", ["o_orderkey", "o_orderdate"]
    cases = {
        "whole": (whole, need),
        "lacking": (whole, [*need, "other", "absent"]),
        "empty": (f"{folder}/empty", need),
        "none": (f"{folder}/none", need),
        "damaged": (f"{folder}/damaged", need),
    }
    reports = [Q.dataset_gate(spark, path, columns).withColumn("kind", F.lit(kind)) for kind, (path, columns) in cases.items()]
    out = reduce(DataFrame.unionByName, reports)
    return out.withColumn("reason", F.substring_index("reason", ":", 1))


@query(
    "schema_rows",
    """SELECT column_name AS "column", CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
              WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(column_type) END AS dtype,
              column_type IN ('BIGINT', 'INTEGER', 'DOUBLE') AS is_numeric, 'missing columns: [''absent'', ''other'']' AS refused
       FROM (DESCRIBE orders)""",
)
def schema_rows(spark, sf):
    """The columns of a table, and the words in which a table without the required ones is refused."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    try:
        Q.require_columns(orders, ["other", "o_orderkey", "absent"])
        refused = ""
    except ValueError as error:
        refused = str(error)
    return Q.schema_listing(orders).withColumn("refused", F.lit(refused))


@query(
    "distinct_codes",
    sql(
        """SELECT array_to_string(list_sort(list(DISTINCT province_code)), ',') AS provinces,
                  array_to_string(list_sort(list(DISTINCT propulsion_code)), ',') AS propulsion FROM reg""",
        "reg",
    ),
)
def distinct_codes(spark, sf):
    return b.registrations(spark, sf).agg(
        F.array_join(F.array_sort(F.collect_set("province_code")), ",").alias("provinces"),
        F.array_join(F.array_sort(F.collect_set("propulsion_code")), ",").alias("propulsion"),
    )

