"""Token ids as Parquet list columns.

Layout of a store: ``tokens/`` holds one row per document in ascending id order
(doc_id, start, n_tokens, ids), cut by id range into files; ``files/`` holds one row
per file with the number of ids in all files before it.  ``start`` counts within the
file, so files are written independently; readers add the file's base.

The id column is dictionary encoded, the ascending number columns are delta encoded.
Row groups and pages are small and carry column and offset indexes (Parquet's
default), so a reader of some documents, or of the number columns alone, fetches
only their pages.

Defined cases: a null text counts as empty and holds just the end id; null ids come
first; rows with equal ids keep the order of their texts; an empty table gives an
empty store; further columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship
from .encoding import encoder

ROW_GROUP_BYTES = 16 * 1024 * 1024
PAGE_BYTES = 128 * 1024
PAGE_ROWS = 1_000
TOKENS = "doc_id long, start long, n_tokens long, ids array<int>"


def encode_rows(vocabulary: str, end_id: int):
    """Batches of (doc_id, text as binary) to batches of `TOKENS`, in the order they come."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, start = encoder(vocabulary), 0
        for part in rows:
            for first, ids, ends in codes.encode(part.column(1), end_id):
                sizes = np.diff(ends)
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.view(np.int32)))
                names = part.column(0).slice(first, len(sizes))
                yield pa.RecordBatch.from_arrays([names, pa.array(start + ends[:-1]), pa.array(sizes), lists], ["doc_id", "start", "n_tokens", "ids"])
                start += int(ends[-1])

    return batches


def write_store(docs: DataFrame, path: str, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts and write a store at ``path``.

    Texts are dealt by id range once (as text, which is smaller than ids) and
    encoded in order where they land; each task writes one file.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    ordered = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), text.cast("binary").alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
    )
    (
        ordered.mapInArrow(encode_rows(vocabulary, end_id), TOKENS)
        .write.option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "false")
        .option("parquet.enable.dictionary#ids.list.element", "true")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.page.size", PAGE_BYTES)
        .option("parquet.page.row.count.limit", PAGE_ROWS)
        .option("maxRecordsPerFile", 0)
        .parquet(f"{path}/tokens")
    )
    spark = docs.sparkSession
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (
        spark.read.schema(TOKENS)
        .parquet(f"{path}/tokens")
        .groupBy(F.col("_metadata.file_name").alias("file"))
        .agg(F.sum("n_tokens").alias("n_ids"), F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .withColumn("part", F.regexp_extract("file", r"part-(\d+)", 1).cast("long"))
        .withColumn("base", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))
        .coalesce(1)
        .write.parquet(f"{path}/files")
    )


def read_store(spark: SparkSession, path: str, first: int | None = None, last: int | None = None, ids: bool = True) -> DataFrame:
    """(doc_id, start, n_tokens[, ids]) of the documents from ``first`` to ``last``; ``start`` counts over the whole store.

    Without ``ids`` only the number columns are read; the id range is pushed to the scan.
    """
    rows = spark.read.schema(TOKENS).parquet(f"{path}/tokens")
    if first is not None:
        rows = rows.where(F.col("doc_id") >= first)
    if last is not None:
        rows = rows.where(F.col("doc_id") <= last)
    rows = rows.withColumn("file", F.col("_metadata.file_name"))
    bases = spark.read.parquet(f"{path}/files").select("file", "base")
    columns = ["doc_id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", *["ids"] * ids]
    return rows.join(bases, "file").select(*columns)


def checksums(rows: DataFrame) -> DataFrame:
    """Each row's ids replaced by ids_crc32: crc32 over the ids as little-endian unsigned 32-bit numbers."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = part.column(part.schema.get_field_index("ids"))
            ends, values = lists.offsets.to_numpy(), lists.values.to_numpy().astype("<u4", copy=False)
            sums = [zlib.crc32(values[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            others = [n for n in part.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([part.column(n) for n in others] + [pa.array(sums, pa.int64())], [*others, "ids_crc32"])

    ship(rows.sparkSession)
    fields = [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "ids"]
    return rows.mapInArrow(batches, ", ".join([*fields, "ids_crc32 long"]))
