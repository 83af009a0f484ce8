"""Best-fit packing by a plan over the histogram of lengths.

Documents longer than a sequence are cut into full pieces and a rest.  How many
pieces there are of each length (as many numbers as a sequence has places) decides
everything: best fit, longest first, runs over these counts and hands out *runs* of
slots, and each piece then takes the slot of its rank among the pieces of its length.

Defined cases: a null text counts as empty and holds just the end id; repeated ids
and rows are packed one by one; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import buckets_for, running_total, ship, stored
from .encoding import encoder

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(vocabulary: str, end_id: int, places: int):
    """Batches of (doc_id, text as binary) to batches of `PIECES`."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = encoder(vocabulary)
        for part in rows:
            names = part.column(0).to_pylist()
            for first, ids, ends in codes.encode(part.column(1), end_id):
                out = []
                for name, a, b in zip(names[first:], ends[:-1].tolist(), ends[1:].tolist(), strict=False):
                    for piece, at in enumerate(range(a, b, places)):
                        own = ids[at : min(at + places, b)]
                        out.append((name, piece, at - a, len(own), zlib.crc32(own.tobytes())))
                columns = list(zip(*out, strict=True)) or [()] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return batches


def plan_slots(counts: dict[int, int], places: int) -> dict[int, list[tuple[int, int, int, int, int]]]:
    """Best fit, longest first, over counts.

    Returns, per length, runs (first rank, end rank, pieces per sequence, first
    sequence, first offset).  ``free[r]`` holds intervals of sequences with r places
    left.  A piece goes to the fullest sequence that takes it, and so do the next ones of
    its length while they fit, so one step serves a whole interval.  A length splits at
    most two intervals and at least halves the room of those it meets, which bounds the
    runs by the number of lengths, whatever the number of pieces.
    """
    free: list[list[tuple[int, int]]] = [[] for _ in range(places + 1)]
    runs: dict[int, list[tuple[int, int, int, int, int]]] = {}
    opened = 0
    for length in sorted(counts, reverse=True):
        left, rank, own = counts[length], 0, runs.setdefault(length, [])
        room = length
        while left:
            while room < places and not free[room]:
                room += 1
            per = room // length
            if room == places:
                free[places].append((opened, -(-left // per)))
                opened += -(-left // per)
            first, many = free[room].pop()
            used = min(left, many * per)
            full, rest = divmod(used, per)
            own.append((rank, rank + used, per, first, places - room))
            if full:
                free[room - per * length].append((first, full))
            if rest:
                free[room - rest * length].append((first + full, 1))
            if many > full + (rest > 0):
                free[room].append((first + full + (rest > 0), many - full - (rest > 0)))
            left, rank = left - used, rank + used
    return runs


def pack(
    docs: DataFrame, vocabulary: str, places: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`PIECES` plus sequence_id and offset, per piece.

    The histogram has at most ``places`` rows and is the only thing the driver sees.
    Ranks are counted in buckets of about the root of a length's pieces, so a length
    that holds most pieces is spread like any other.
    """
    ship(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    pieces = stored(source.mapInArrow(cut(vocabulary, end_id, places), PIECES), "pieces")
    spark = docs.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    runs = plan_slots(counts, places)
    kind = "array<struct<first:long,end:long,per:long,sequence:long,place:long>>"
    known = spark.createDataFrame([(k, n) for k, n in counts.items()], "length long, n long")
    slots = spark.createDataFrame(list(runs.items()), f"length long, runs {kind}")
    # both tables have at most `places` rows, and the runs are bounded with them
    dealt = (
        pieces.join(F.broadcast(known), "length")
        .withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), buckets_for(F.col("n"))))
        .drop("n")
        .withColumn("one", F.lit(1).cast("long"))
    )
    ranked = running_total(dealt, "length", "bucket", ["doc_id", "piece", "ids_crc32"], "one", "rank")
    run = F.element_at(F.filter("runs", lambda r: F.col("rank") < r["end"]), 1)
    within = F.col("rank") - F.col("run.first")
    return (
        ranked.join(F.broadcast(slots), "length")
        .withColumn("run", run)
        .select(
            "doc_id",
            "piece",
            "start",
            "length",
            "ids_crc32",
            (F.col("run.sequence") + F.floor(within / F.col("run.per"))).alias("sequence_id"),
            (F.col("run.place") + within % F.col("run.per") * F.col("length")).alias("offset"),
        )
    )
