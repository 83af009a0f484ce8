"""Incremental ingest: new files become months of a Parquet table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.fixed_width import parse_registrations


def stream_lines(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    """Lines of new text files, with the file they came from."""
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_trigger)
        .load(folder)
        .select("value", F.col("_metadata.file_name").alias("source_file"))
    )


#: hidden from readers of the table: what each batch has stored
MANIFEST = "_manifest"


def _recorded(spark: SparkSession, table: str, part: str) -> DataFrame | None:
    try:
        return spark.read.parquet(f"{table}/{MANIFEST}/{part}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _without(rows: DataFrame, recorded: DataFrame | None, columns: Sequence[str], batch: str) -> DataFrame:
    """Rows whose ``columns`` no other batch has recorded."""
    if recorded is None:
        return rows
    # months and file names: one short row each, far fewer than the lines they stand for
    others = recorded.where(F.col("batch") != batch).select(*columns).distinct()
    return rows.join(others, list(columns), "left_anti")


def ingest_months(
    stream: DataFrame,
    table: str,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = ("year", "month"),
    overwrite: bool = False,
    skip_stored: bool = False,
    file_col: str = "source_file",
) -> None:
    """Process all files that have arrived since the last run, then stop.

    A batch writes into a folder of its own under each month, named by the stream and the
    batch, and then records its files and months in the table's manifest.  A batch that
    is run again after a failure replaces its own folder, and counts once it is recorded
    (`read_months`); so months may arrive over several batches and streams, and nothing
    is lost.  A file that another batch has recorded is left out, also when it comes
    again under another checkpoint; the stream then needs the column ``file_col``.

    With ``skip_stored`` months that are stored already are left alone as a whole, with
    ``overwrite`` they are replaced.  Both take all new files as one batch, since a
    month's files may not be torn apart.
    """
    keys, spark = list(keys), stream.sparkSession
    known_files = file_col in stream.columns

    def store(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = f"{session.sparkContext.getLocalProperty('sql.streaming.queryId')}-{batch_id}"
        if known_files and not overwrite:
            batch = _without(batch, _recorded(session, table, "files"), [file_col], name)
        rows = prepare(batch)
        if skip_stored:
            rows = _without(rows, _recorded(session, table, "months"), keys, name)
        partitions = keys if overwrite else [*keys, "batch"]
        if not overwrite:
            rows = rows.withColumn("batch", F.lit(name))
        (
            rows.hint("rebalance", *keys)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(table)
        )
        if overwrite:
            return

        def record(entries: DataFrame, part: str) -> None:
            placed = entries.withColumn("batch", F.lit(name)).coalesce(1)
            placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{table}/{MANIFEST}/{part}")

        if known_files:
            record(batch.select(file_col).distinct(), "files")
        # last: from here on the batch counts
        record(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")), "months")

    when = {"once": True} if overwrite or skip_stored else {"availableNow": True}
    query = stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(**when).start()
    query.awaitTermination()


def read_months(spark: SparkSession, table: str) -> DataFrame:
    """Rows of the batches that are recorded; what a broken run has left behind does not count."""
    rows = spark.read.option("basePath", table).parquet(table)
    recorded = _recorded(spark, table, "months")
    if "batch" not in rows.columns:
        return rows
    if recorded is None:
        return rows.limit(0)
    return rows.join(recorded.select("batch").distinct(), "batch", "left_semi").drop("batch")


def registrations_by_month(lines: DataFrame) -> DataFrame:
    """Parsed registrations with the year and month they are stored under."""
    parsed = parse_registrations(lines).where("registration_date IS NOT NULL")
    return parsed.withColumns({"year": F.year("registration_date"), "month": F.month("registration_date")})
