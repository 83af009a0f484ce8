"""Top-k, samples, exact quantiles, row numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import settings as S
from ..session import materialise
from .quantiles import exact_quantiles
from .tables import literal_table


def top_k(df: DataFrame, k: int, by: str, ties: Sequence[str]) -> DataFrame:
    """The ``k`` largest rows; ``ties`` decide among equal values."""
    return df.orderBy(F.col(by).desc(), *(F.col(c).asc() for c in ties)).limit(k)


def head(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First rows in order."""
    return df.orderBy(*order).limit(n)


def tail(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """Last rows in order."""
    return df.orderBy(*(F.col(c).desc() for c in order)).limit(n).orderBy(*order)


def value_counts(df: DataFrame, *columns: str, count: str = "n", k: int | None = None) -> DataFrame:
    """Rows per value combination, most frequent first."""
    counted = df.groupBy(*columns).agg(F.count(F.lit(1)).alias(count))
    ordered = counted.orderBy(F.col(count).desc(), *columns)
    return ordered if k is None else ordered.limit(k)


def seeded_sample(df: DataFrame, ids: Sequence[str], n: int = S.SAMPLE_SIZE, seed: int = S.SAMPLE_SEED) -> DataFrame:
    """``n`` rows chosen by a digest of the seed and their ids: repeatable, independent of row order."""
    lot = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in ids]).cast("binary"))
    return df.withColumn("_lot", lot).orderBy("_lot", *ids).limit(n).drop("_lot")


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group in the given order.

    Computed as a minimum over row structs, which combines before the shuffle,
    so a group that holds most rows does not end up in one sort.
    """
    names = [f"_o{i}" for i in range(len(order))]
    row = F.struct(*(c.alias(n) for c, n in zip(order, names)), F.struct(*df.columns).alias("_row"))
    return df.groupBy(*keys).agg(F.min(row).alias("_first")).select("_first._row.*")


def exact_quantile(df: DataFrame, column: str, q: float, name: str = "threshold") -> DataFrame:
    """One row with the exact linear-interpolated quantile (null without values)."""
    return literal_table(df.sparkSession, [name], exact_quantiles(df, [column], [q]).values()).select(F.col(name).cast("double"))


def above_quantile(df: DataFrame, column: str, share: float = S.EXPAND_SHARE) -> DataFrame:
    """Rows in the top ``share`` by value; rows equal to the threshold are kept."""
    threshold = exact_quantiles(df, [column], [1 - share])[column][0]
    return df.where(F.col(column) >= F.lit(threshold).cast("double"))


def number_rows(df: DataFrame, order: Sequence[str], name: str = "row_id") -> DataFrame:
    """Consecutive numbers from 1 in a total order, without one global window.

    Rows are range-partitioned and sorted, stored once so that partitions stay
    put, and numbered inside their partition on top of the rows before it.
    The table of partition sizes has one row per partition.
    """
    rows = materialise(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    block = F.shiftright(F.col("_mid"), 33)
    sizes = rows.groupBy(block.alias("_block")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    within = F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        rows.withColumn("_block", block)
        .join(F.broadcast(offsets), "_block")
        .select(*df.columns, (F.col("_before") + within + 1).alias(name))
    )


def with_labels(df: DataFrame, order: Sequence[str], prefix: str, name: str, width: int = 3) -> DataFrame:
    """Consecutive labels such as ``IBE_001``."""
    numbered = number_rows(df, order, "_seq")
    label = F.format_string(f"{prefix}_%0{width}d", F.col("_seq"))
    return numbered.select(label.alias(name), *df.columns)


def ratio_to_max(df: DataFrame, column: str, name: str) -> DataFrame:
    """Value over the largest value of the column (read as a scalar)."""
    return df.withColumn(name, F.col(column) / df.agg(F.max(column)).scalar())
