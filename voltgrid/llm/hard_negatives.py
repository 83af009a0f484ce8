"""Hard negatives: rotated one-bit codes, deterministic intervals, integer scores.

A vector's code is the sign of its components after some fixed random rotations; stored
with it are its alignment (the inner product with its own code's direction) and the
length of the residual beside that direction.  An anchor is quantised to a few bit planes,
so popcounts of planes and codes give its inner product with a candidate's code
direction.  By Cauchy-Schwarz the residual adds at most the product of the two parts
beside the direction, so each score lies in an interval that never fails.  Candidates whose
interval misses what is still wanted are left out; the others are scored with integers.

What is wanted is known early: a search runs over hash samples of the candidates, each
many times the one before, and the k-th best of a sample is the least score of the
next.  So the rows that blocks give out grow with the anchors, not with anchors times
candidates; blocks meet in a bounded number of rows on either side.

Defined cases: rows without id or label, and vectors that are null, hold a null or a
number that is not finite, have an unusual length or a length of 2^31.5 or more after
rounding (their scores need not fit a long) take no part; zero vectors do; each of several rows
with one id takes part on its own; ties go to the smaller id; an anchor without
positives or negatives gives no rows; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stored
from .vectors import meet, usual_length

#: rotations, each giving as many bits as a vector has components
ROTATIONS = 4
#: bits that an anchor's rotated component is quantised to
PLANES = 6
#: anchors of a block, and bytes of its candidates' vectors
ANCHOR_ROWS, BLOCK_BYTES = 1_024, 16 << 20
#: rows of the first sample; how many times as many the next one has
FIRST_ROWS, GROWTH = 32_768, 16
#: scores fit a long if vectors are shorter than this, squared
MOST_SQUARE = 2.0**63

ITEM = "row long, id long, label long, vector binary, code binary, align double, across double, norm double"


def rotations(length: int, count: int, seed: int) -> np.ndarray:
    """Stacked random rotations, (count * length) x length, that keep lengths as a whole."""
    made = [np.linalg.qr(np.random.default_rng([seed, k]).standard_normal((length, length)))[0] for k in range(count)]
    return np.concatenate(made) / np.sqrt(count) if length else np.zeros((0, 0))


def encode(vectors: np.ndarray, turned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (bits, packed), alignments, residuals and lengths of the code directions, by stacked rotations."""
    bits = vectors @ turned.T > 0
    direction = np.where(bits, 1.0, -1.0) @ turned
    norms = np.maximum(np.sqrt((direction * direction).sum(1)), 1e-300)
    align = (direction * vectors).sum(1) / norms
    across = np.sqrt(np.maximum((vectors * vectors).sum(1) - align * align, 0))
    return np.packbits(bits, axis=1), align, across, norms


def _words(code: np.ndarray) -> np.ndarray:
    """Packed bits as 64-bit words (filled up with zeros), one row per word."""
    spare = -code.shape[1] % 8
    return np.ascontiguousarray(np.pad(code, ((0, 0), (0, spare))).view("<u8").T)


class Block:
    """Candidates of a block, with what their intervals need."""

    def __init__(self, table: pa.Table, turned: np.ndarray):
        self.turned, n = turned, table.num_rows
        whole = lambda name, kind: np.frombuffer(b"".join(table.column(name).to_pylist()), kind).reshape(n, -1)
        self.vectors = whole("vector", "<i8")
        self.row, self.id, self.label = (table.column(c).to_numpy() for c in ("row", "id", "label"))
        self.align, self.across, self.norm = (table.column(c).to_numpy() for c in ("align", "across", "norm"))
        self.code = _words(whole("code", np.uint8))
        self.ones = np.bitwise_count(self.code).sum(0, dtype=np.int64)

    def interval(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the anchor's inner product with each candidate."""
        turned = self.turned @ anchor
        square = float(anchor @ anchor)
        low, step = turned.min(), np.ptp(turned) / (2**PLANES - 1)
        number = np.rint((turned - low) / step).astype(np.int64) if step > 0 else np.zeros(len(turned), np.int64)
        rounded = low + step * number
        planes = _words(np.packbits((number[None, :] >> np.arange(PLANES)[:, None]).astype(np.uint8) & 1, axis=1))
        counts = np.zeros(len(self.ones), np.int64)
        for j in range(PLANES):
            for word in range(len(planes)):
                counts += np.bitwise_count(self.code[word] & planes[word, j]).astype(np.int64) << j
        along = (2 * (low * self.ones + step * counts) - rounded.sum()) / self.norm
        off = np.sqrt(len(turned)) * np.sqrt(((turned - rounded) ** 2).sum()) / self.norm
        beside = self.across * np.sqrt(np.maximum(square - np.maximum(np.abs(along) - off, 0) ** 2, 0))
        spare = 1e-9 * np.sqrt(square) * (np.abs(self.align) + self.across) + 1e-6
        middle, room = self.align * along, np.abs(self.align) * off + beside + spare
        return middle - room, middle + room

    def score(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Exact inner products: no partial sum exceeds the product of the lengths."""
        return np.einsum("ij,j->i", self.vectors[at], anchor)


def best(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first, by falling score, then id, then row."""
    if len(scores) > 4 * k:  # ties with the k-th stay in
        near = np.flatnonzero(scores >= -np.partition(-scores, k - 1)[k - 1])
        return near[np.lexsort((rows[near], ids[near], -scores[near]))[:k]]
    return np.lexsort((rows, ids, -scores))[:k]


def prepare(df: DataFrame, id_col: str, vector_col: str, label_col: str, scale: float, turns: int, seed: int) -> tuple[DataFrame, np.ndarray]:
    """Stored `ITEM` rows of the vectors that take part, and the rotations."""
    ship(df.sparkSession)
    length = usual_length(df, vector_col)
    turned = rotations(length, turns, seed)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            inner = part.column(3).flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # a null is not a number here
            with np.errstate(all="ignore"):
                values = np.floor(inner.reshape(-1, length) * scale)
                fine = np.flatnonzero(np.isfinite(values).all(1) & ((values * values).sum(1) < MOST_SQUARE * (1 - 1e-9)))
            for i in range(0, len(fine), 8192):
                own = fine[i : i + 8192]
                code, align, across, norm = encode(values[own], turned)
                pack = lambda rows: pa.array([r.tobytes() for r in rows], pa.binary())
                rows = part.take(pa.array(own))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), rows.column(2), pack(values[own].astype("<i8")), pack(code), pa.array(align), pa.array(across), pa.array(norm)],
                    ["row", "id", "label", "vector", "code", "align", "across", "norm"],
                )

    vector = F.col(vector_col)
    rows = df.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (F.size(vector) == length) & F.lit(length > 0))
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector)
    return stored(rows.mapInArrow(batches, ITEM), "items"), turned


def _levels(items: DataFrame, first_rows: int, growth: int) -> list[Column]:
    """Conditions of the samples, from the first to the whole."""
    n, every = items.count(), 1
    while n > first_rows * every:
        every *= growth
    out = []
    while every >= 1:
        out.append(F.pmod(F.xxhash64("row", F.lit("level")), F.lit(every)) == 0)
        every //= growth
    return out


def _search(
    items: DataFrame,
    wanted: DataFrame,
    within: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], np.ndarray],
    keys: list[str],
    turned: np.ndarray,
    k: int,
    levels: list[Column],
    anchor_rows: int,
    rows: int,
) -> DataFrame:
    """(anchor, slot, row, id, score): the k first candidates of each slot of each anchor.

    ``wanted`` has (anchor, aid, alabel, own, low, high, slots): the anchor's vector
    and, per slot, the least and largest score wanted.  ``within`` tells candidates
    that may be given at all.
    """
    out = "anchor long, slot int, row long, id long, score long"

    def probe(key: tuple, anchors: pa.Table, table: pa.Table) -> pa.Table:
        found: list[tuple] = []
        block = Block(table, turned) if table.num_rows else None
        anchors = anchors if block else anchors.slice(0, 0)
        given = (anchors.column(c).to_pylist() for c in ("anchor", "aid", "alabel", "own", "slot", "low", "high"))
        for anchor, aid, label, own, slots, lows, highs in zip(*given, strict=True):
            vector = np.frombuffer(own, "<i8")
            under, over = block.interval(vector.astype(np.float64))
            at = np.flatnonzero((over >= min(lows)) & (under <= max(highs)) & within(block, anchor, aid, label))
            scores = block.score(at, vector)
            for slot, low, high in zip(slots, lows, highs, strict=True):
                fit = np.flatnonzero((scores >= low) & (scores <= high))
                fit = fit[best(scores[fit], block.id[at[fit]], block.row[at[fit]], k)]
                found += zip([anchor] * len(fit), [slot] * len(fit), block.row[at[fit]].tolist(), block.id[at[fit]].tolist(), scores[fit].tolist(), strict=True)
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["anchor", "slot", "row", "id", "score"])

    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    held = None
    for level in levels:
        asked = wanted
        if held is not None:
            # the k-th best so far is the least score that can still enter
            bound = held.groupBy("anchor", "slot").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
            asked = wanted.join(bound.select("anchor", "slot", "least"), ["anchor", "slot"], "left").withColumn("low", F.greatest("low", F.coalesce("least", "low"))).drop("least")
        slots = asked.groupBy("anchor", "aid", "alabel", "own", *keys).agg(F.sort_array(F.collect_list(F.struct("slot", "low", "high"))).alias("slots"))
        slots = slots.select("anchor", "aid", "alabel", "own", *keys, "slots.slot", "slots.low", "slots.high")
        slots = stored(slots.withColumn("salt", F.col("anchor")), "asked")
        part = items.where(level).withColumn("salt", F.col("row"))
        found = meet(slots, part, keys, anchor_rows, rows, salt="salt").applyInArrow(probe, out)
        held = stored(found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).drop("n"), "found")
    return held


def mine(
    df: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 10,
    shares: tuple[int, int] = (30, 90),
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    turns: int = ROTATIONS,
    seed: int = 11,
    anchor_rows: int = ANCHOR_ROWS,
    block_bytes: int = BLOCK_BYTES,
    first_rows: int = FIRST_ROWS,
    growth: int = GROWTH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors`` is a condition on ``id`` and ``label``.  Components become
    floor(scale * x).  An anchor's positives are its first rows of the same label; the
    negatives of each positive are the first rows of other labels whose score, in
    percent of the positive's, lies within ``shares``.
    """
    items, turned = prepare(df, id_col, vector_col, label_col, scale, turns, seed)
    asked = items.where(anchors).select(F.col("row").alias("anchor"), F.col("id").alias("aid"), F.col("label").alias("alabel"), F.col("vector").alias("own"))
    every = (F.lit(-(2**63)), F.lit(2**63 - 1))
    wanted = asked.select("*", F.col("alabel").alias("label"), F.lit(0).alias("slot"), every[0].alias("low"), every[1].alias("high"))
    levels, rows = _levels(items, first_rows, growth), max(1, block_bytes // max(8 * turned.shape[1], 1))

    def same(block, anchor, aid, label):
        return (block.row != anchor) & (block.label == label)

    def other(block, anchor, aid, label):
        return block.label != label

    near = _search(items, wanted, same, ["label"], turned, positives, levels, anchor_rows, rows)
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id", "row")
    near = stored(near.select("anchor", F.row_number().over(order).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")

    score = F.col("positive_score").cast("decimal(19,0)")
    least, most = (F.lit(s).cast("decimal(4,0)") for s in shares)
    # least * p <= 100 * n <= most * p, for whole n
    bands = near.select(
        "anchor", "slot", F.ceil(score * least / 100).cast("long").alias("low"), F.floor(score * most / 100).cast("long").alias("high")
    ).where("low <= high")
    wanted = asked.join(bands, "anchor").withColumn("all", F.lit(0))
    far = _search(items.withColumn("all", F.lit(0)), wanted, other, ["all"], turned, negatives, levels, anchor_rows, rows)
    rank = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id", "row")
    ranked = far.select("anchor", "slot", F.row_number().over(rank).alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    return (
        ranked.join(near, ["anchor", "slot"])
        .join(asked.select("anchor", F.col("aid").alias("anchor_id")), "anchor")
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
