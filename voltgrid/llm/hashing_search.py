"""Nearest neighbours by largest inner product, with multi-index hashing.

Vectors get binary codes: signs after learned rotations (iterative quantisation on a
bounded sample; one rotation per ``length`` bits).  A further component lifts all
vectors to the largest norm, so that angles order as inner products do.  Codes are split
into substrings, each with its own index.  Two codes within radius r agree in some
substring up to its threshold if the thresholds plus one sum to r + 1, so probing every
substring's index within its threshold retrieves every code within r; what is retrieved
is reranked by the inner products of the original vectors in double precision.

Each query has its own radius: the distance that the expected k-th best score has with
some margin.  A query that finds fewer than k, or whose k-th score proves that the
radius was too small, goes again with a larger one, up to all bits, which retrieves
every row; so queries always end with k results if there are as many rows.  Blocks of the
index are met in the order of the distance of their leading bits: once k rows are
found, farther blocks give only rows that reach the k-th score.

Defined cases: vectors that are null, zero, not finite or of an unusual length, and rows
without id, take no part; of rows with equal ids one counts (the smallest bytes); ties
go to the smaller id; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, log2, pi, sqrt
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship, stored
from .vectors import item_kind, matrix, meet, packed, usual_length

#: rows the rotations are learned on, rows each query's scores are estimated on
SAMPLE_ROWS = 4_096
BITS = 128
#: one-sided margin of the radius, in standard deviations of the distance at the k-th score
MARGIN = 1.65
#: rows of a block of the index, queries of a block, values compared at once
INDEX_ROWS, QUERY_ROWS, COMPARED = 8_192, 1_024, 1 << 21
#: most leading bits of a substring that index blocks are kept by
MOST_LEAD = 8


def learn_rotations(rows: np.ndarray, bits: int, rounds: int = 15) -> np.ndarray:
    """A (length, bits) matrix of rotations; each turns the rows so that they lie near the corners of a cube."""
    random, out = np.random.default_rng(11), []
    for _ in range(-(-bits // rows.shape[1])):
        turn = np.linalg.qr(random.standard_normal((rows.shape[1], rows.shape[1])))[0]
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.sign(rows @ turn).T @ rows)
            turn = (left @ right).T
        out.append(turn)
    return np.concatenate(out, axis=1)[:, :bits]


class Coder:
    """Rows of original vectors to codes and, for queries, to radii."""

    def __init__(self, sample: np.ndarray, largest: float, total: int, k: int, bits: int = BITS):
        self.largest, self.bits = largest, bits
        self.sample, self.turn = sample, learn_rotations(self.lifted(sample), bits)
        self.z = NormalDist().inv_cdf(1 - min(0.5, k / max(total, 1)))

    def lifted(self, rows: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(0.0, self.largest**2 - (rows * rows).sum(1)))
        return np.concatenate([rows, rest[:, None]], axis=1)

    def codes(self, lifted: np.ndarray) -> np.ndarray:
        """(rows, bits / 32) numbers."""
        return np.packbits(lifted @ self.turn > 0, axis=1).view("<u4").reshape(len(lifted), -1)

    def query_codes(self, rows: np.ndarray) -> np.ndarray:
        return self.codes(np.concatenate([rows, np.zeros((len(rows), 1))], axis=1))

    def radius(self, cosine: float) -> int:
        """Bits that two codes differ in at an angle, with the margin."""
        share = acos(max(-1.0, min(1.0, cosine))) / pi
        return min(self.bits, ceil(self.bits * share + MARGIN * sqrt(self.bits * share * (1 - share))))

    def radii(self, rows: np.ndarray) -> list[int]:
        """First radius of each query, from its scores on the sample; one bit more spares most queries a second turn."""
        norms = np.linalg.norm(rows, axis=1) * self.largest
        scores = rows @ self.sample.T / norms[:, None]
        return [min(self.bits, self.radius(c) + 1) for c in (scores.mean(1) + self.z * scores.std(1)).tolist()]


def allowed(radius: np.ndarray, parts: int) -> np.ndarray:
    """(queries, parts) thresholds; -1 leaves a substring out."""
    rest = radius[:, None] + 1 - parts
    return rest // parts + (np.arange(parts) < rest % parts)


def _codes(coder: Coder, kind: str, length: int):
    """Batches of (id, vector) to one row per substring, with the substring's leading bits in ``lead``."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                codes = coder.codes(coder.lifted(matrix(part.column(1), kind, length)))
                n, m = codes.shape
                again = pa.array(np.repeat(np.arange(n), m))
                whole = [c.tobytes() for c in codes]
                columns = [part.column(0).take(again), part.column(1).take(again), pa.array(whole, pa.binary()).take(again)]
                values = codes.ravel().astype(np.int64)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.tile(np.arange(m, dtype=np.int32), n)), pa.array(values)], ["id", "vector", "code", "part", "value"])

    return batches


def _queries(coder: Coder, kind: str, length: int):
    """Batches of (id, vector) to (id, vector, code, radius)."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if part.num_rows:
                rows = matrix(part.column(1), kind, length)
                codes = [c.tobytes() for c in coder.query_codes(rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(codes, pa.binary()), pa.array(coder.radii(rows), pa.int32())], ["id", "vector", "code", "radius"]
                )

    return batches


def _probe(kind: str, length: int, parts: int, k: int):
    """Looks up a block's queries in a block of one substring's index; the k best of each query that reach its floor."""

    def probe(index: pa.Table, queries: pa.Table) -> pa.Table:
        found_q, found_id, found_score = [], [], []
        if index.num_rows and queries.num_rows:
            part = index.column("part")[0].as_py()
            # the index: rows in the order of the substring's values, with where each value begins
            codes = np.frombuffer(b"".join(index.column("code").to_pylist()), "<u4").reshape(-1, parts)
            order = np.argsort(codes[:, part], kind="stable")
            codes, ids = codes[order], index.column("id").to_numpy()[order]
            rows = matrix(index.column("vector"), kind, length)[order]
            values, begin, many = np.unique(codes[:, part], return_index=True, return_counts=True)
            asked = np.frombuffer(b"".join(queries.column("code").to_pylist()), "<u4").reshape(-1, parts)
            radius = queries.column("radius").to_numpy().astype(np.int64)
            limits = allowed(radius, parts)
            vectors, names = matrix(queries.column("vector"), kind, length), queries.column("id").to_numpy()
            floor = queries.column("floor").to_numpy()
            step = max(1, COMPARED // max(len(codes), 1))
            for at in range(0, len(asked), step):
                mine = slice(at, at + step)
                q, v = np.nonzero(np.bitwise_count(asked[mine, part][:, None] ^ values[None, :]) <= limits[mine, part][:, None])
                q = q + at
                size = many[v]
                row = np.repeat(begin[v], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                q = np.repeat(q, size)
                apart = np.bitwise_count(asked[q] ^ codes[row]).astype(np.int64)
                # a code that an earlier substring retrieves is left to that one
                new = (apart.sum(1) <= radius[q]) & (ids[row] != names[q]) & (apart[:, :part] > limits[q][:, :part]).all(1)
                q, row = q[new], row[new]
                score = np.concatenate([np.einsum("ij,ij->i", vectors[q[i : i + 65536]], rows[row[i : i + 65536]]) for i in range(0, len(q), 65536)] or [np.zeros(0)])
                enough = score >= floor[q]
                q, row, score = q[enough], row[enough], score[enough]
                best = np.lexsort((ids[row], -score, q))
                q, row, score = q[best], row[best], score[best]
                start = np.searchsorted(q, q)
                top = np.arange(len(q)) - start < k
                found_q.append(names[q[top]])
                found_id.append(ids[row[top]])
                found_score.append(score[top])
        joined = [np.concatenate(x) if x else np.zeros(0) for x in (found_q, found_id, found_score)]
        return pa.table([pa.array(joined[0].astype(np.int64)), pa.array(joined[1].astype(np.int64)), pa.array(joined[2].astype(np.float64))], names=["query_id", "vec_id", "score"])

    return probe


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", bits: int = BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest that each query finds.

    ``is_query`` is a condition over the column ``id``.
    """
    spark = df.sparkSession
    ship(spark)
    length, kind = usual_length(df, vector_col), item_kind(df, vector_col)
    rows = packed(df, id_col, vector_col, length).where(F.col("vector").isNotNull() & F.col("id").isNotNull())
    rows = stored(rows.groupBy("id").agg(F.min("vector").alias("vector"), F.min("norm").alias("norm")), "vectors")
    total, largest = rows.agg(F.count("*"), F.max("norm")).first()
    empty = "query_id long, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = [r["vector"] for r in rows.orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS).select("vector").collect()]
    parts = bits // 32
    coder = Coder(np.frombuffer(b"".join(sample), kind).astype(np.float64).reshape(len(sample), length), largest, total, k, bits)
    lead = min(MOST_LEAD, max(0, ceil(log2(max(1, total / INDEX_ROWS)))))
    head = lambda value: F.shiftright(value, 32 - lead)
    index = rows.select("id", "vector").mapInArrow(_codes(coder, kind, length), "id long, vector binary, code binary, part int, value long")
    index = stored(index.withColumn("lead", head(F.col("value"))).drop("value"), "index")
    coded = rows.where(is_query).select("id", "vector").mapInArrow(_queries(coder, kind, length), "id long, vector binary, code binary, radius int")
    pending = stored(coded, "queries")
    wanted, done = min(k, total - 1), []

    # thresholds of the substrings as columns, and the leading bits within them
    rest = F.col("radius") + 1 - parts
    limit = lambda p: F.floor(rest / parts) + F.when(F.pmod(rest, F.lit(parts)) > p, 1).otherwise(0)
    byte = lambda at: F.conv(F.hex(F.substring("code", at, 1)), 16, 10).cast("long")
    word = lambda p: sum((F.shiftleft(byte(4 * p + 1 + i), 8 * i) for i in range(4)), F.lit(0).cast("long"))
    reach = F.array(*[F.struct(F.lit(p).alias("part"), head(word(p)).alias("lead"), limit(p).alias("limit")) for p in range(parts)])
    every = F.sequence(F.lit(0).cast("long"), F.lit((1 << lead) - 1).cast("long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while wanted > 0:
        # the nearest blocks go first; a k-th score found there is a floor for what the farther ones have to give
        farthest = pending.agg(F.max(F.greatest(*[limit(p) for p in range(parts)]))).first()[0]
        found = spark.createDataFrame([], empty)
        for apart in range(min(lead, farthest if farthest is not None else -1) + 1):
            floors = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("floor")).where(F.col("n") >= k)
            floored = pending.join(floors.select("id", "floor"), "id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
            asked = floored.withColumn("at", F.explode(reach)).where(F.col("at.limit") >= apart)
            leads = F.filter(every, lambda x: _distance(x, F.col("at.lead")) == apart)  # noqa: B023
            asked = asked.select("id", "vector", "code", "radius", "floor", F.col("at.part").alias("part"), F.explode(leads).alias("lead"))
            met = meet(index, asked, ["part", "lead"], INDEX_ROWS, QUERY_ROWS)
            more = found.select("query_id", "vec_id", "score").unionByName(met.applyInArrow(_probe(kind, length, parts, k), empty))
            found = stored(more.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")
        if "rank" not in found.columns:
            found = found.withColumn("rank", F.lit(0))
        # does the k-th score prove that the radius was enough?
        worst = found.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"), F.min("score").alias("worst"))
        share = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("worst") / (F.col("norm") * largest)))) / pi
        needed = F.ceil(bits * share + MARGIN * F.sqrt(bits * share * (1 - share)))
        wider = F.when(F.coalesce("n", F.lit(0)) < wanted, F.col("radius") + max(8, bits // 8)).otherwise(needed)
        judged = pending.join(worst, "id", "left").join(rows.select("id", "norm"), "id").withColumn("wider", F.least(wider, F.lit(bits)).cast("int"))
        judged = stored(judged, "judged")
        enough = F.col("wider") <= F.col("radius")
        done.append(found.join(judged.where(enough).select(F.col("id").alias("query_id")), "query_id", "left_semi"))
        pending = judged.where(~enough).select("id", "vector", "code", F.col("wider").alias("radius"))
        if pending.isEmpty():
            break
    out = spark.createDataFrame([], f"{empty}, rank int")
    for part in done:
        out = out.unionByName(part)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
