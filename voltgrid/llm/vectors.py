"""Vectors as bytes, and blocks of two sides that meet by key."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from .common import ship


def usual_length(df: DataFrame, vector_col: str) -> int:
    """The most frequent length of the vectors (of equally frequent ones the smallest; 0 without vectors)."""
    lengths = df.where(F.col(vector_col).isNotNull()).groupBy(F.size(vector_col).alias("n")).agg(F.count("*").alias("rows"))
    first = lengths.orderBy(F.desc("rows"), "n").first()
    return first["n"] if first else 0


def item_kind(df: DataFrame, vector_col: str) -> str:
    """The numpy kind that holds the vectors' components exactly."""
    kind = df.schema[vector_col].dataType
    return "<f4" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "<f8"


def packed(df: DataFrame, id_col: str, vector_col: str, length: int, label_col: str | None = None) -> DataFrame:
    """(id, label, vector, norm): the components as bytes.

    ``vector`` is null where the vector is null, zero, of another length than
    ``length``, or holds a null or a number that is not finite.
    """
    spark = df.sparkSession
    ship(spark)
    kind = item_kind(df, vector_col)
    width = np.dtype(kind).itemsize

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(2)
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            ends = lists.offsets.to_numpy()
            sizes = np.diff(ends)
            inner = lists.values
            values = inner.to_numpy(zero_copy_only=False).astype(np.float64)
            if inner.null_count:
                values = np.where(inner.is_valid().to_numpy(zero_copy_only=False), values, np.nan)
            good = np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & (sizes == length) & (length > 0))
            rows = values[ends[good][:, None] + np.arange(length)] if len(good) else np.zeros((0, length))
            with np.errstate(over="ignore", invalid="ignore"):
                norms = np.sqrt((rows * rows).sum(1))
            fine = np.isfinite(rows).all(1) & np.isfinite(norms) & (norms > 0)
            out: list[bytes | None] = [None] * len(sizes)
            of: list[float | None] = [None] * len(sizes)
            whole = (rows[fine] + 0.0).astype(kind).tobytes()
            for k, (row, norm) in enumerate(zip(good[fine].tolist(), norms[fine].tolist(), strict=True)):
                out[row], of[row] = whole[k * length * width : (k + 1) * length * width], norm
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(out, pa.binary()), pa.array(of, pa.float64())], ["id", "label", "vector", "norm"]
            )

    label = F.col(label_col) if label_col else F.lit(None).cast("int")
    rows = df.select(F.col(id_col).cast("long").alias("id"), label.alias("label"), F.col(vector_col))
    return rows.mapInArrow(batches, f"id long, label {rows.schema['label'].dataType.simpleString()}, vector binary, norm double")


def matrix(column, kind: str, length: int) -> np.ndarray:
    """A column of packed vectors as rows of doubles."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), kind).astype(np.float64).reshape(len(values), length)


def meet(left: DataFrame, right: DataFrame, keys: list[str], left_rows: int, right_rows: int, salt: str = "id"):
    """The two sides cogrouped by key, in blocks of about the given numbers of rows.

    A key with more rows is dealt into chunks by the hash of ``salt``, and each chunk of
    one side meets each chunk of the other, so no block grows with a key.
    """
    sizes = left.groupBy(*keys).agg(F.count("*").alias("l")).join(right.groupBy(*keys).agg(F.count("*").alias("r")), keys)
    sizes = sizes.select(*keys, F.ceil(F.col("l") / left_rows).alias("l"), F.ceil(F.col("r") / right_rows).alias("r"))

    def side(df: DataFrame, own: str, other: str) -> DataFrame:
        dealt = df.join(sizes, keys).withColumn(f"__{own}", F.pmod(F.xxhash64(salt), F.col(own)))
        dealt = dealt.withColumn(f"__{other}", F.explode(F.sequence(F.lit(0).cast("long"), F.col(other) - 1))).drop("l", "r")
        return dealt.toDF(*dealt.columns)  # columns of their own: both sides may come from one table

    blocks = [*keys, "__l", "__r"]
    return side(left, "l", "r").groupBy(*blocks).cogroup(side(right, "r", "l").groupBy(*blocks))
