"""Near copies among vectors of one label, with an inverted multi-index.

Each half of the (unit) vectors has its own codebook; a vector's cell is its pair of
nearest codewords.  Codebooks are fitted on a bounded sample, every vector is indexed.
A vector visits cells in the order of their distance (the multi-sequence traversal of
the two lists of codewords) until the target recall, and what it meets is verified by
cosine in double precision.  How many cells that takes is measured on sample vectors
with partners turned away by exactly the threshold's angle, the hardest ones that must
be found; a link is found from either side.

Blocks of members and visitors are bounded, hot cells are dealt into chunks, and a block
returns numbers of links and a spanning forest, never its pairs.

Defined cases: vectors that are null, zero, not finite, of an unusual length or without
label link with nothing and stand for themselves; equal vectors are collapsed first and
counted with their copies; a null id never names a component and is not kept; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored
from .components import connected_components
from .vectors import item_kind, matrix, meet, packed, usual_length

#: rows the codebooks are fitted on, perturbed rows the traversal is measured on
SAMPLE_ROWS = 10_000
MEASURED_ROWS = 2_000
#: members of a cell aimed at, codewords of a half
CELL_ROWS = 16
MOST_WORDS = 256
TARGET_RECALL = 0.99
#: rows of a block
MEMBERS, VISITORS = 4_096, 8_192


def fit_words(rows: np.ndarray, words: int, rounds: int = 12) -> np.ndarray:
    """Codewords of a half by k-means (Lloyd), from evenly spaced rows on."""
    centres = rows[np.linspace(0, len(rows) - 1, words).astype(int)].copy()
    for _ in range(rounds):
        near = nearest(rows, centres)[:, 0]
        for k in range(words):
            own = rows[near == k]
            if len(own):
                centres[k] = own.mean(0)
    return centres


def squares(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows and codewords."""
    return (rows * rows).sum(1)[:, None] - 2 * rows @ centres.T + (centres * centres).sum(1)


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Numbers of the codewords, nearest first."""
    return np.argsort(squares(rows, centres), axis=1, kind="stable")


def traverse(first: np.ndarray, second: np.ndarray) -> Iterator[tuple[int, int]]:
    """Places (i, j) in two ascending lists in the order of first[i] + second[j]."""
    heap, pushed = [(first[0] + second[0], 0, 0)], {(0, 0)}
    while heap:
        _, i, j = heappop(heap)
        yield i, j
        for a, b in ((i + 1, j), (i, j + 1)):
            if a < len(first) and b < len(second) and (a, b) not in pushed:
                pushed.add((a, b))
                heappush(heap, (first[a] + second[b], a, b))


class Index:
    """The two codebooks and the number of cells to visit."""

    def __init__(self, rows: np.ndarray, words: int, threshold: float, recall: float = TARGET_RECALL):
        self.half = max(1, rows.shape[1] // 2)
        words = max(1, min(words, len(rows)))
        self.books = [fit_words(rows[:, : self.half], words), fit_words(rows[:, self.half :], words) if rows.shape[1] > 1 else np.zeros((1, 0))]
        self.visits = self.measure(rows, threshold, recall)

    def measure(self, rows: np.ndarray, threshold: float, recall: float) -> int:
        random = np.random.default_rng(7)
        rows = rows[:: max(1, len(rows) // MEASURED_ROWS)]
        aside = random.standard_normal(rows.shape)
        aside -= (aside * rows).sum(1, keepdims=True) * rows
        size = np.linalg.norm(aside, axis=1, keepdims=True)
        turned = threshold * rows + np.sqrt(max(0.0, 1 - threshold * threshold)) * aside / np.where(size > 0, size, 1)
        first, second = squares(rows[:, : self.half], self.books[0]), squares(rows[:, self.half :], self.books[1])
        ranks = np.array([(x[:, None] + y[None, :] <= x[i] + y[j]).sum() for x, y, (i, j) in zip(first, second, self.cells(turned).tolist(), strict=True)])
        return int(np.quantile(ranks, recall, method="higher")) if len(ranks) else 1

    def cells(self, rows: np.ndarray) -> np.ndarray:
        return np.stack([squares(h, b).argmin(1) for h, b in zip((rows[:, : self.half], rows[:, self.half :]), self.books, strict=True)], axis=1)

    def visited(self, rows: np.ndarray) -> Iterator[list[tuple[int, int]]]:
        """Cells of each row's traversal, as (i, j)."""
        lists = []
        for part, book in zip((rows[:, : self.half], rows[:, self.half :]), self.books, strict=True):
            far = squares(part, book)
            order = np.argsort(far, axis=1, kind="stable")
            lists.append((order.tolist(), np.take_along_axis(far, order, 1).tolist()))
        (first, near_first), (second, near_second) = lists
        for a, da, b, db in zip(first, near_first, second, near_second, strict=True):
            cells = []
            for i, j in traverse(da, db):
                cells.append((a[i], b[j]))
                if len(cells) >= self.visits:
                    break
            yield cells


def _place(index: Index, kind: str, length: int):
    """Batches of (id, label, vector, n) to one row per first codeword that is visited.

    ``own`` is the second codeword of the row's cell if its first one is this row's, else
    -1; ``visits`` are the second codewords visited; ``all_visits`` all cells.
    """
    words = len(index.books[1])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            rows = matrix(part.column(2), kind, length)
            rows /= np.linalg.norm(rows, axis=1, keepdims=True)
            take, first, own, visits, every = [], [], [], [], []
            for r, (cell, cells) in enumerate(zip(index.cells(rows).tolist(), index.visited(rows), strict=True)):
                by_first: dict[int, list[int]] = {cell[0]: []}
                for i, j in cells:
                    by_first.setdefault(i, []).append(j)
                flat = [i * words + j for i, j in cells]
                for i, js in by_first.items():
                    take.append(r)
                    first.append(i)
                    own.append(cell[1] if i == cell[0] else -1)
                    visits.append(js)
                    every.append(flat if i == cell[0] else [])
            picked = pa.array(take, pa.int64())
            columns = [part.column(k).take(picked) for k in range(4)]
            lists = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(first, pa.int32()), pa.array(own, pa.int32()), pa.array(visits, lists), pa.array(every, lists)],
                ["id", "label", "vector", "n", "first", "own", "visits", "all_visits"],
            )

    return batches


def _roots(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """A spanning forest of the links."""
    above: dict[int, int] = {}

    def root(x: int) -> int:
        while above.get(x, x) != x:
            above[x] = above.get(above[x], above[x])
            x = above[x]
        return x

    out = []
    for x, y in zip(a, b, strict=True):
        p, q = root(x), root(y)
        if p != q:
            above[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _verify(kind: str, length: int, words: int, threshold: float):
    """Links of a block: (id, n, other) rows; n are the copies linked with id, other a link of the forest."""

    def verify(members: pa.Table, visitors: pa.Table) -> pa.Table:
        ids, links, others = [], [], []
        if members.num_rows and visitors.num_rows:
            left, right = matrix(members.column("vector"), kind, length), matrix(visitors.column("vector"), kind, length)
            left_norms, right_norms = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
            left_ids, right_ids = (t.column("id").to_numpy() for t in (members, visitors))
            left_n, right_n = (t.column("n").to_numpy() for t in (members, visitors))
            cell = members.column("own").to_numpy()
            first = int(members.column("first")[0].as_py())
            member_visits = [set(v) for v in members.column("all_visits").to_pylist()]
            home = visitors.column("home").to_pylist()
            lists = visitors.column("visits").to_pylist()
            flat = np.array([j for js in lists for j in js], np.int64)
            who = np.repeat(np.arange(len(lists)), [len(js) for js in lists])
            a_all, b_all = [], []
            for j in np.unique(cell).tolist():
                mine, theirs = np.flatnonzero(cell == j), who[flat == j]
                for at in range(0, len(theirs), 1024):
                    some = theirs[at : at + 1024]
                    cosine = (right[some] @ left[mine].T) / (right_norms[some][:, None] * left_norms[mine][None, :])
                    v, m = np.nonzero(cosine >= threshold)
                    v, m = some[v], mine[m]
                    other = right_ids[v] != left_ids[m]
                    v, m = v[other], m[other]
                    # a link that the member finds from its side too counts there, if its id is smaller
                    larger = right_ids[v] > left_ids[m]
                    twice = np.array([h in s for h, s in zip([home[x] for x in v[larger].tolist()], [member_visits[x] for x in m[larger].tolist()], strict=True)], bool)
                    keep = np.ones(len(v), bool)
                    keep[np.flatnonzero(larger)[twice]] = False
                    a_all.append(m[keep])
                    b_all.append(v[keep])
            if a_all:
                m, v = np.concatenate(a_all), np.concatenate(b_all)
                for own_ids, at, n in ((left_ids, m, right_n[v]), (right_ids, v, left_n[m])):
                    total = np.bincount(at, n, minlength=len(own_ids)).astype(np.int64)
                    hit = np.flatnonzero(total)
                    ids += own_ids[hit].tolist()
                    links += total[hit].tolist()
                    others += [None] * len(hit)
                for x, y in _roots(left_ids[m].tolist(), right_ids[v].tolist()):
                    ids.append(x)
                    links.append(0)
                    others.append(y)
        return pa.table([pa.array(ids, pa.int64()), pa.array(links, pa.int64()), pa.array(others, pa.int64())], names=["id", "n", "other"])

    return verify


def near_copies(
    df: DataFrame, threshold: float, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", recall: float = TARGET_RECALL
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    spark = df.sparkSession
    ship(spark)
    length, kind = usual_length(df, vector_col), item_kind(df, vector_col)
    rows = stored(packed(df, id_col, vector_col, length, label_col).withColumn("digest", F.md5("vector")), "vectors")
    valid = rows.where(F.col("vector").isNotNull() & F.col("label").isNotNull())
    # one row per distinct vector of a label; its number is the hash of both
    classes = stored(
        valid.groupBy(F.xxhash64("label", "digest").alias("id"), "label", "digest")
        .agg(F.first("vector").alias("vector"), F.count("*").alias("n"), F.min("id").alias("least"))
        .drop("digest"),
        "classes",
    )
    total, labels = classes.agg(F.count("*"), F.approx_count_distinct("label")).first()
    sample = [r["vector"] for r in classes.orderBy(F.xxhash64("id")).limit(SAMPLE_ROWS).select("vector").collect()]
    if sample:
        fitted = np.frombuffer(b"".join(sample), kind).astype(np.float64).reshape(len(sample), length)
        fitted /= np.linalg.norm(fitted, axis=1, keepdims=True)
        words = int(np.clip(np.sqrt(total / (max(labels, 1) * CELL_ROWS)), 2, MOST_WORDS))
        index = Index(fitted, words, threshold, recall)
        schema = f"id long, label {classes.schema['label'].dataType.simpleString()}, vector binary, n long, first int, own int, visits array<int>, all_visits array<int>"
        placed = stored(classes.select("id", "label", "vector", "n").mapInArrow(_place(index, kind, length), schema), "placed")
        width = len(index.books[1])
        homes = placed.where(F.col("own") >= 0).select("id", (F.col("first") * width + F.col("own")).alias("home"))
        members = placed.where(F.col("own") >= 0).select("label", "first", "id", "n", "vector", "own", "all_visits")
        visitors = placed.where(F.size("visits") > 0).select("label", "first", "id", "n", "vector", "visits").join(homes, "id")
        met = meet(members, visitors, ["label", "first"], MEMBERS, VISITORS)
        found = stored(met.applyInArrow(_verify(kind, length, width, threshold), "id long, n long, other long"), "found")
    else:
        found = spark.createDataFrame([], "id long, n long, other long")
    links = found.groupBy("id").agg(F.sum("n").alias("linked"))
    roots = connected_components(found.where(F.col("other").isNotNull()), "id", "other").withColumnRenamed("node", "id")
    named = classes.drop("vector").join(links, "id", "left").join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    named = stored(named.select("id", "n", "least", F.coalesce("linked", F.lit(0)).alias("linked"), "root"), "named")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    whole = named.join(names, "root").select(F.col("id").alias("class"), (F.col("linked") + F.col("n") - 1).alias("n_links"), "component_id")
    own = F.when(F.col("vector").isNotNull() & F.col("label").isNotNull(), F.xxhash64("label", "digest"))
    alone = F.col("class").isNull()
    return (
        rows.select("id", own.alias("of"))
        .join(whole, F.col("of") == F.col("class"), "left")
        .select(
            F.col("id").alias("vec_id"),
            F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
            F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
