"""Monthly series from registrations."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import settings as S
from ..functions.dates import month_of
from ..functions.numeric import clip

WIDE_SERIES = [S.BEV, S.OTHER, S.ALL_CARS, S.ELECTRIFIED, S.NORMAL_CARS, S.TOTAL]


def month_calendar(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Every month from ``start`` to ``end``, both included."""
    return spark.sql(
        f"SELECT explode(sequence(DATE'{start:%Y-%m-01}', DATE'{end:%Y-%m-01}', INTERVAL 1 MONTH)) AS month"
    )


def category_breakdown(df: DataFrame, kind: str = "rechargeable_ev_type") -> DataFrame:
    """Vehicles per rechargeable type, most frequent first."""
    return (
        df.where(F.col(kind).isNotNull())
        .groupBy(kind)
        .agg(F.count(F.lit(1)).cast("long").alias("n"))
        .orderBy(F.col("n").desc(), kind)
    )


def overall_counts(df: DataFrame) -> DataFrame:
    """Record counts laid out as ``metric, value`` rows, in one pass."""
    metrics: Mapping[str, Column] = {
        "total_records": F.count(F.lit(1)),
        "rechargeable_ev_bev_phev_reev": F.count_if("is_rechargeable_ev"),
        "battery_electric_vehicles_bev": F.count_if("is_bev"),
        "plug_in_hybrid_phev": F.count_if("is_phev"),
        "range_extended_reev": F.count_if("is_reev"),
    }
    wide = df.agg(*(c.cast("long").alias(name) for name, c in metrics.items()))
    return wide.unpivot([], list(metrics), "metric", "value")


def monthly_by_bucket(df: DataFrame, date: str = "registration_date") -> DataFrame:
    """Vehicles per month and bucket, long form."""
    return (
        df.where(F.col("bucket").isNotNull())
        .groupBy(month_of(F.col(date)).alias("month"), "bucket")
        .agg(F.count(F.lit(1)).cast("long").alias("n_vehicles"))
    )


def pivot_counts(df: DataFrame, index: str, on: str, value: str, values: Sequence[str]) -> DataFrame:
    """Long to wide over a known value list; absent combinations give zero."""
    return (
        df.groupBy(index).pivot(on, list(values)).agg(F.sum(value).cast("long")).na.fill(0, subset=list(values))
    )


def monthly_market_totals(df: DataFrame, date: str = "registration_date") -> DataFrame:
    """All, electrified and other vehicles per month."""
    return (
        df.groupBy(month_of(F.col(date)).alias("month"))
        .agg(
            F.count(F.lit(1)).cast("long").alias(S.ALL_CARS),
            F.count_if("is_rechargeable_ev").cast("long").alias(S.ELECTRIFIED),
        )
        .withColumn(S.NORMAL_CARS, F.col(S.ALL_CARS) - F.col(S.ELECTRIFIED))
    )


def monthly_series(df: DataFrame, start: dt.date, end: dt.date, date: str = "registration_date") -> DataFrame:
    """The gap-free wide series: one row per month, zero where nothing was registered.

    One pass over the registrations: the buckets and totals are conditional
    counts of one aggregation (partial counts per task, then at most one row
    per month and task in the shuffle), joined to the calendar afterwards.
    """
    first, past = start.replace(day=1), (end.replace(day=1) + dt.timedelta(days=31)).replace(day=1)
    counts = (
        df.where((F.col(date) >= F.lit(first)) & (F.col(date) < F.lit(past)))  # a plain range, so files can skip it
        .groupBy(month_of(F.col(date)).alias("month"))
        .agg(
            F.count_if(F.col("bucket") == S.BEV).alias(S.BEV),
            F.count_if(F.col("bucket") == S.OTHER).alias(S.OTHER),
            F.count(F.lit(1)).alias(S.ALL_CARS),
            F.count_if("is_rechargeable_ev").alias(S.ELECTRIFIED),
        )
    )
    counted = [S.BEV, S.OTHER, S.ALL_CARS, S.ELECTRIFIED]
    dense = month_calendar(df.sparkSession, start, end).join(counts, "month", "left")
    dense = dense.select("month", *(F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c) for c in counted))
    return dense.select(
        "*",
        clip(F.col(S.ALL_CARS) - F.col(S.ELECTRIFIED), low=0).cast("long").alias(S.NORMAL_CARS),
        (F.col(S.BEV) + F.col(S.OTHER)).alias(S.TOTAL),
    )


def to_long(wide: DataFrame, series: Sequence[str], name: str = "series", value: str = "y") -> DataFrame:
    """Wide months to ``series, month, y``."""
    return wide.select("month", *series).unpivot("month", list(series), name, value)


def growth_index(wide: DataFrame, series: Sequence[str] = (S.BEV, S.OTHER, S.TOTAL), total: str = S.TOTAL) -> DataFrame:
    """Value over the first month with a positive total, times 100; a base below one counts as one."""
    started = to_long(wide.where(F.col(total) > 0), list(series))
    first = F.first("y").over(Window.partitionBy("series").orderBy("month"))
    return started.select(
        "month", "series", (F.col("y") / F.greatest(first, F.lit(1)) * 100).alias("growth_index")
    )


def month_gaps(long: DataFrame) -> DataFrame:
    """Days to the previous month per series, and whether the spacing looks monthly."""
    previous = F.lag("month").over(Window.partitionBy("series").orderBy("month"))
    return (
        long.select("series", F.datediff(F.col("month"), previous).cast("long").alias("gap"))
        .groupBy("series")
        .agg(
            F.countDistinct("gap").cast("long").alias("distinct_gaps"),
            F.max("gap").alias("longest_gap_days"),
            (F.countDistinct("gap") <= 4).alias("is_monthly"),
        )
    )


def split_holdout(wide: DataFrame, months: int = S.HOLDOUT_MONTHS) -> tuple[DataFrame, DataFrame]:
    """All but the last ``months`` rows, and the last ``months`` rows (one row per month)."""
    last = wide.agg(F.max("month")).scalar()
    edge = F.add_months(last, -months)
    return wide.where(F.col("month") <= edge), wide.where(F.col("month") > edge)


def histories(long: DataFrame, key: str = "series", value: str = "y") -> DataFrame:
    """One row per series: its values in month order and its last month.

    The array holds one number per month, so its length is bounded by the
    calendar; what grows with the data is the number of series, one row each.
    """
    return (
        long.groupBy(F.col(key).alias("Series"))
        .agg(F.sort_array(F.collect_list(F.struct("month", F.col(value).cast("double").alias("y")))).alias("h"))
        .select("Series", F.col("h.y").alias("history"), F.expr("element_at(h, -1).month AS last_month"))
    )
