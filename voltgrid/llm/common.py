"""What several operators share: stored tables and sums along an order."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voltgrid.session import ensure_checkpoint_dir


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application.

    Operators that run Python in tasks call it first, so the package need not be
    installed on the cluster.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix=f"{package.name}-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for module in sorted(package.rglob("*.py")):
            out.write(module, module.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _shipped.add(sc.applicationId)


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which driver and executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the checkpoint folder and read it back.

    Cuts the lineage: what follows reads files that outlive any executor.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path that `shared_path` has given."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def buckets_for(count: Column) -> Column:
    """Number of buckets of a group: the root of its rows, so that neither the rows
    of a bucket nor the buckets of a group grow as fast as the group."""
    return F.ceil(F.sqrt(F.greatest(count, F.lit(1)).cast("double")))


def running_total(df: DataFrame, group: str, bucket: str, order: list, value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group that stand before.

    Rows stand in the order (bucket, *order).  Sums run inside buckets; a second,
    short sum runs over the buckets, so no task holds a whole group.  ``group`` and
    ``bucket`` hold no nulls.
    """
    sums = df.groupBy(group, bucket).agg(F.sum(value).alias("__sum"))
    ahead = Window.partitionBy(group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(group, bucket, F.coalesce(F.sum("__sum").over(ahead), F.lit(0)).alias("__base"))
    inside = Window.partitionBy(group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    inner = df.withColumn("__inner", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    return (
        inner.join(bases, [group, bucket], "left")
        .withColumn(out, F.coalesce("__base", F.lit(0)) + F.col("__inner"))
        .drop("__base", "__inner")
    )
