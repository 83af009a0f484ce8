"""Near copies by SimHash, found with a generalised pigeonhole.

The 64 bits are grouped into partitions, correlated bits together.  If the thresholds
t of the partitions satisfy sum(t + 1) = limit + 1, two fingerprints within the limit
agree in some partition up to its threshold (-1 leaves a partition out), so probing
every partition within its threshold finds every link.  Widths and thresholds are
chosen by dynamic programming over estimated numbers of probes and candidates, from
statistics of all fingerprints.  Candidates are verified by the distance of the whole
fingerprints inside the join.

Defined cases: null and empty texts have no word and fingerprint zero, and link like
any other; fewer words than a shingle are one shingle; equal fingerprints are
collapsed before the search; a null id belongs to its group but never names it; an
empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .components import connected_components

BITS = 64
#: cost of a candidate pair in units of a probe row
CANDIDATE_COST = 0.2
#: most values that one probe of a partition may take
PROBES = 2_000


def _votes(hashes: list[int]) -> int:
    bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    ones = sum((bits[i : i + 65536].sum(0, dtype=np.int64) for i in range(0, len(bits), 65536)), np.zeros(BITS, np.int64))
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprint_of(text: bytes | None, shingle: int, seed: int) -> int:
    """SimHash of a text as a signed 64-bit number: a bit is set if it is in over half the shingles' XXH64."""
    from xxhash import xxh64_intdigest

    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return 0
    if len(words) <= shingle:
        return _votes([xxh64_intdigest(b" ".join(words), seed)])
    joined = b" ".join(words)
    ends = (np.cumsum([len(w) + 1 for w in words]) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    return _votes([xxh64_intdigest(joined[i:j], seed) for i, j in zip(starts, ends[shingle - 1 :], strict=False)])


def fingerprint(text: Column, shingle: int = 4, seed: int = 42) -> Column:
    """Column of fingerprints (long)."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint_of(t, shingle, seed) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def bit_counts(prints: DataFrame, column: str) -> np.ndarray:
    """64 x 64 matrix: in how many rows both bits are set.  Tasks send one matrix each."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS))
        for part in parts:
            values = np.ascontiguousarray(part.column(0).to_numpy(zero_copy_only=False).astype("<i8"))
            for i in range(0, len(values), 65536):
                bits = np.unpackbits(values[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
                total += bits.T @ bits
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BITS * BITS, dtype=np.int32)), pa.array(total.ravel().astype(np.int64))], ["cell", "n"])

    cells = prints.select(column).mapInArrow(batches, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(BITS * BITS)
    for row in cells:
        out[row["cell"]] = row["n"]
    return out.reshape(BITS, BITS)


def group_bits(both: np.ndarray, n: int, parts: int) -> list[list[int]]:
    """Bits in ``parts`` groups of nearly equal size; each group takes the bit that correlates most with it."""
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(share * (1 - share), 1e-12))
    alike = np.abs(both / max(n, 1) - np.outer(share, share)) / np.outer(spread, spread)
    np.fill_diagonal(alike, 0)
    left, groups = set(range(BITS)), []
    for i in range(parts):
        width = BITS // parts + (i < BITS % parts)
        group = [max(sorted(left), key=lambda b: alike[b, sorted(left)].sum())]
        left.remove(group[0])
        while len(group) < width:
            best = max(sorted(left), key=lambda b: alike[b, group].sum())
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


def thresholds(both: np.ndarray, n: int, groups: list[list[int]], limit: int) -> tuple[float, list[int]]:
    """Least estimated cost and the thresholds that have it.

    A pair's distance in a partition is taken as a sum of independent bits, each equal
    with the chance the counts give it.
    """
    share = np.diag(both) / max(n, 1)
    cost: list[list[float]] = []
    for group in groups:
        chance = np.array([1.0])
        for b in group:
            differ = 2 * share[b] * (1 - share[b])
            chance = np.append(chance * (1 - differ), 0) + np.append(0, chance * differ)
        balls = np.cumsum([comb(len(group), d) for d in range(limit + 1)])
        near = np.cumsum(chance)[: limit + 1]
        cost.append([0.0, *(n * balls[t] + CANDIDATE_COST * n * n / 2 * near[t] if balls[t] <= PROBES else float("inf") for t in range(limit + 1))])
    # best[s]: least cost of the partitions so far with thresholds plus one that sum to s
    best: list[tuple[float, list[int]]] = [(0.0, [])] + [(float("inf"), [])] * (limit + 1)
    for own in cost:
        best = [
            min(((best[s - k][0] + own[k], [*best[s - k][1], k - 1]) for k in range(s + 1)), key=lambda x: x[0])
            for s in range(limit + 2)
        ]
    return best[limit + 1]


def plan(both: np.ndarray, n: int, limit: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the partitions to probe."""
    options = []
    for parts in range(1, limit + 2):
        groups = group_bits(both, n, parts)
        cost, allowed = thresholds(both, n, groups, limit)
        if len(allowed) == parts and cost < float("inf"):
            options.append((cost, [(g, t) for g, t in zip(groups, allowed, strict=True) if t >= 0]))
    return min(options, key=lambda x: x[0])[1]


def _mask(bits) -> int:
    value = sum(1 << b for b in bits)
    return value - (1 << BITS) if value >> (BITS - 1) else value


def links(prints: DataFrame, limit: int, column: str = "fingerprint") -> DataFrame:
    """(a, b) with a < b: all pairs of distinct fingerprints at most ``limit`` bits apart; a pair may repeat.

    ``prints`` holds each fingerprint once.  The side that is looked up has one row
    per partition and fingerprint; the probing side one row per value in reach.
    """
    n = prints.count()
    parts = plan(bit_counts(prints, column), n, limit)
    value = F.col(column)
    index, probes = [], []
    for k, (bits, reach) in enumerate(parts):
        flips = [_mask(c) for d in range(reach + 1) for c in combinations(bits, d)]
        own = value.bitwiseAND(F.lit(_mask(bits)))
        index.append(F.array(F.struct(F.lit(k).alias("part"), own.alias("key"))))
        probes.append(F.transform(F.array(*[F.lit(f) for f in flips]), lambda f: F.struct(F.lit(k).alias("part"), own.bitwiseXOR(f).alias("key"))))  # noqa: B023
    looked_up = prints.select(value.alias("b"), F.explode(F.concat(*index)).alias("at")).select("at.part", "at.key", "b")
    probing = prints.select(value.alias("a"), F.explode(F.concat(*probes)).alias("at")).select("at.part", "at.key", "a")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= limit
    same = (probing["part"] == looked_up["part"]) & (probing["key"] == looked_up["key"])
    return probing.hint("merge").join(looked_up, same & (F.col("a") < F.col("b")) & near).select("a", "b")


def near_copies(docs: DataFrame, shingle: int = 4, limit: int = 4, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_hash, fingerprint, component_id, component) per document.

    ``component_id`` is the smallest id reachable by links.  ``component`` is the
    component's smallest fingerprint, and ``text_hash`` a hash of the text: they tell
    components and rows apart where ids are equal or null.
    """
    ship(docs.sparkSession)
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), fingerprint(text, shingle, seed).alias("fingerprint")
    )
    rows = stored(rows, "fingerprints")
    classes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "classes")
    roots = connected_components(links(classes, limit))
    named = classes.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    named = stored(named, "named")
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    own = named.join(names, "root").select("fingerprint", "component_id", F.col("root").alias("component"))
    return rows.join(own, "fingerprint").select("doc_id", "text_hash", "fingerprint", "component_id", "component")


def first_of_each(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stand for their group: its smallest id (of equal ids the smallest text hash).

    Repeated rows stay once.  A group without ids keeps one of its rows.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    kept = groups.groupBy("component").agg(F.min(order).alias("first"))
    kept = kept.select(F.struct("first.id", "first.hash").alias("__key"))
    own = F.struct(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"))
    return docs.withColumn("__key", own).dropDuplicates(["__key"]).join(kept, "__key", "left_semi").drop("__key")
