"""Gates, audits and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quantiles import exact_quantiles
from .tables import literal_table

GATE_COLUMNS = ["is_valid", "reason", "row_count", "missing_columns"]


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Stop before a plan is built on a table that lacks columns."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {missing}")


def gate_report(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row: valid or not, the reason, the row count, the columns that are missing."""
    missing = ",".join(sorted(set(required) - set(df.columns)))
    counted = df.agg(F.count(F.lit(1)).cast("long").alias("row_count"))
    if missing:
        reason: Column = F.lit("missing_columns")
    else:
        reason = F.when(F.col("row_count") > 0, "ok").otherwise("empty_table")
    return counted.select(
        (reason == "ok").alias("is_valid"),
        reason.alias("reason"),
        F.when(reason == "missing_columns", 0).otherwise(F.col("row_count")).cast("long").alias("row_count"),
        F.lit(missing).alias("missing_columns"),
    )


def dataset_gate(spark: SparkSession, path: str, required: Sequence[str]) -> DataFrame:
    """Gate for a Parquet path; a path that does not exist or does not read gives a row too."""
    try:
        df = spark.read.parquet(path)
    except (PySparkException, Py4JJavaError) as error:
        # a damaged footer comes as an error of the job that reads it, not of the analysis
        condition = error.getCondition() if isinstance(error, PySparkException) else "CANNOT_READ"
        reason = "file_missing" if condition == "PATH_NOT_FOUND" else f"read_failed: {condition}"
        return literal_table(spark, GATE_COLUMNS, [(False, reason, 0, "")]).withColumn(
            "row_count", F.col("row_count").cast("long")
        )
    return gate_report(df, required)


def schema_listing(df: DataFrame) -> DataFrame:
    """One row per column: name, type, numeric or not."""
    rows = [(f.name, f.dataType.simpleString(), isinstance(f.dataType, T.NumericType)) for f in df.schema]
    return literal_table(df.sparkSession, ["column", "dtype", "is_numeric"], rows)


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per column with its number of nulls, in one pass."""
    names = list(columns or df.columns)
    wide = df.agg(*(F.count_if(F.col(c).isNull()).cast("long").alias(c) for c in names))
    return wide.unpivot([], names, "column", "null_count")


def summary_statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, nulls, mean, standard deviation, minimum, quartiles, maximum per column.

    Quartiles are exact (linear between neighbours), by distributed selection; the others
    take one pass.
    """
    quarters = (0.25, 0.5, 0.75)
    stats, found = [], exact_quantiles(df, columns, quarters)
    for c in columns:
        v = F.col(c).cast("double")
        stats.append(
            F.struct(
                F.lit(c).alias("column"),
                F.count(v).cast("long").alias("count"),
                F.count_if(v.isNull()).cast("long").alias("null_count"),
                F.avg(v).alias("mean"),
                F.stddev_samp(v).alias("std"),
                F.min(v).alias("min"),
                *(F.lit(x).cast("double").alias(f"p{100 * q:.0f}") for x, q in zip(found[c], quarters)),
                F.max(v).alias("max"),
            )
        )
    return df.agg(F.array(*stats).alias("s")).select(F.inline("s"))


def month_coverage(df: DataFrame, calendar: DataFrame, month: str = "month") -> DataFrame:
    """One row: first and last month, months expected, present and missing, gap-free or not."""
    present = df.where(F.col(month).isNotNull()).select(F.col(month).alias("month")).distinct()
    marked = calendar.select("month").join(present.withColumn("_seen", F.lit(1)), "month", "left")
    return marked.agg(
        F.min(F.when(F.col("_seen") == 1, F.col("month"))).alias("first_month"),
        F.max(F.when(F.col("_seen") == 1, F.col("month"))).alias("last_month"),
        F.count(F.lit(1)).cast("long").alias("months_expected"),
        F.count("_seen").cast("long").alias("months_present"),
        F.count_if(F.col("_seen").isNull()).cast("long").alias("months_missing"),
        (F.count("_seen") == F.count(F.lit(1))).alias("is_gap_free"),
    )


def missing_months(df: DataFrame, calendar: DataFrame, month: str = "month") -> DataFrame:
    """Calendar months without a row."""
    return calendar.select("month").join(df.select(F.col(month).alias("month")).distinct(), "month", "left_anti")


def assert_no_rows(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """The table itself, failing at run time when a row meets the condition."""
    check = F.when(condition, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.where(check)


def flow_profile(od: DataFrame) -> DataFrame:
    """One row over the origin-destination table.

    Distinct routes and pairs are counted in branches of their own, each over the
    columns it needs: several distinct counts in one aggregation would multiply all rows.
    """

    def distinct(*columns: str) -> Column:
        known = od.select(*columns).na.drop().distinct()
        return known.agg(F.count(F.lit(1)).cast("long").alias("n")).scalar()

    return od.agg(
        F.coalesce(F.sum("trips"), F.lit(0.0)).alias("total_trips"),
        F.avg("distance_km").alias("avg_distance_km"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    ).select(
        "total_trips",
        distinct("route_id").alias("unique_routes"),
        distinct("origin_zone", "destination_zone").alias("unique_pairs"),
        "avg_distance_km",
        "first_date",
        "last_date",
    )


def segment_profile(segments: DataFrame) -> DataFrame:
    """One row over the segment table."""
    return segments.agg(
        F.countDistinct("segment_id").cast("long").alias("unique_segments"),
        F.avg("trips_total").alias("avg_trips_per_segment"),
    )


def approx_flow_profile(od: DataFrame, error: float = 0.02) -> DataFrame:
    """Distinct counts by sketch, for tables where the exact ones cost too much."""
    return od.agg(
        F.approx_count_distinct("route_id", error).alias("unique_routes"),
        F.approx_count_distinct(F.struct("origin_zone", "destination_zone"), error).alias("unique_pairs"),
    )
