"""Profiles that add up: sums and distinct-count sketches per day, merged over any window.

A stored day is one row (a sketch takes 2^`LOG_SIZE` bytes at most), so a profile of
any set of days reads those rows and never the flows again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LOG_SIZE = 12
#: relative standard error of a distinct count
STANDARD_ERROR = 1.04 / 2 ** (LOG_SIZE / 2)


def flow_sketches(od: DataFrame, by: Sequence[str] = ("date",)) -> DataFrame:
    """One row per group of the origin-destination table with what profiles are made of.

    Nulls are not counted; a pair with a null end is none.  Rows without a group
    (null) are a group of their own.
    """
    pair = F.concat(F.col("origin_zone"), F.lit("\u0001"), F.col("destination_zone"))
    return od.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("trips").alias("trips"),
        F.sum("distance_km").alias("km"),
        F.count("distance_km").alias("n_km"),
        F.hll_sketch_agg(F.col("route_id").cast("string"), F.lit(LOG_SIZE)).alias("routes"),
        F.hll_sketch_agg(pair, F.lit(LOG_SIZE)).alias("pairs"),
    )


def merge_sketches(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Profiles of unions of groups, one row per value of ``by``; distinct counts are estimates."""
    return parts.groupBy(*by).agg(
        F.sum("n_rows").cast("long").alias("n_rows"),
        F.coalesce(F.sum("trips"), F.lit(0.0)).alias("total_trips"),
        F.try_divide(F.sum("km"), F.sum("n_km")).alias("avg_distance_km"),
        F.hll_sketch_estimate(F.hll_union_agg("routes")).alias("unique_routes"),
        F.hll_sketch_estimate(F.hll_union_agg("pairs")).alias("unique_pairs"),
    )
