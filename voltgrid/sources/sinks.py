"""Writers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession


def stored_keys(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame | None:
    """Partitions already in a table, or nothing when the table is not there yet.

    A table that is there but does not read is an error, not a new table.
    """
    try:
        return spark.read.parquet(path).select(*keys).distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def write_new_months(df: DataFrame, path: str, keys: Sequence[str] = ("year", "month"), overwrite: bool = False) -> None:
    """One folder per month; months already stored are left alone unless ``overwrite``.

    Rows are moved to their month before writing, so a month becomes few files;
    ``overwrite`` replaces only the months in ``df``.
    """
    keys = list(keys)
    if not overwrite:
        stored = stored_keys(df.sparkSession, path, keys)
        if stored is not None:
            df = df.join(stored, keys, "left_anti")
    mode = "overwrite" if overwrite else "append"
    (
        df.hint("rebalance", *keys)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )


def write_parquet(df: DataFrame, path: str, compression: str = "zstd", partition_by: Sequence[str] = ()) -> None:
    """Consolidated Parquet table."""
    writer = df.write.mode("overwrite").option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_result_csv(tables: Mapping[str, DataFrame], folder: str, single_file: bool = False) -> None:
    """Result tables as CSV with header, a sub-folder each.

    ``single_file`` is for report-sized tables only (years x scenarios); others
    are written by all tasks.
    """
    for name, df in tables.items():
        (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", "true").csv(f"{folder}/{name}")


def write_flows(df: DataFrame, path: str) -> None:
    """Cleaned flows as Parquet by date."""
    df.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "date"
    ).parquet(path)


def read_parquet(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Parquet folder or glob."""
    return spark.read.parquet(path) if isinstance(path, str) else spark.read.parquet(*path)
