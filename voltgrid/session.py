"""Session helpers: settings, and cutting lineage safely."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Settings the plans rely on.  All of them are ordinary Spark settings; a
#: cluster's own values win because they are only applied to new sessions.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # geometry is much work on few bytes: do not merge it into one task
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64KB",
    # one key may hold a third of all rows: cut join partitions above 64 MB that are
    # three times the median, on the side that may be cut, at run time
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "3",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # call-site capture costs milliseconds per column expression while plans are built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("voltgrid")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; invent one only on one machine."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    shared = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        sc.setCheckpointDir(shared)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="voltgrid-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")


def materialise(df: DataFrame) -> DataFrame:
    """Store ``df`` reliably and continue from the stored rows.

    Used where a small intermediate result feeds many branches (so that the raw
    scan runs once) and between rounds of an iterative operator.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Largest table, in estimated bytes, that is sent whole to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


def join_way(table: DataFrame, row_bytes: str, limit: int = BROADCAST_BYTES) -> str:
    """Hint for the short side of a join, from an upper bound of its size.

    ``row_bytes`` is an SQL expression over ``table`` whose sum bounds the bytes
    of the side (a row may stand for the pieces it will be cut into).  Up to
    ``limit`` the side is broadcast, so the long side is not shuffled.  Beyond
    that both sides are shuffled by key and the skew join cuts large keys.
    """
    size = table.selectExpr(f"coalesce(sum({row_bytes}), 0) AS size").first()["size"]
    return "broadcast" if size <= limit else "merge"
