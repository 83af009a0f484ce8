"""Hard negatives against brute force; intervals against exact scores."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from voltgrid.llm import hard_negatives, queries

KIND = [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())]


def plain(rows, anchor, positives=5, negatives=10, shares=(30, 90), scale=256):
    """Result rows of (id, vector, label) with labels as they count."""
    taken = []
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            taken.append((i, [math.floor(scale * x) for x in v], label))
    out = []
    for at, (a, va, la) in enumerate(taken):
        if not anchor(a):
            continue
        scored = [(-sum(x * y for x, y in zip(va, v, strict=True)), i, label) for k, (i, v, label) in enumerate(taken) if k != at]
        first = sorted(s for s in scored if s[2] == la)[:positives]
        for p, pid, _ in first:
            fit = sorted(s for s in scored if s[2] != la and shares[0] * -p <= 100 * -s[0] <= shares[1] * -p)[:negatives]
            out += [(a, pid, rank, nid, -p, -n) for rank, (n, nid, _) in enumerate(fit, 1)]
    return sorted(out)


def sample(n, length, seed, labels=10):
    random = np.random.default_rng(seed)
    rows = random.standard_normal((n, length)) + 1.5 * random.standard_normal((6, length))[random.integers(0, 6, n)]
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    rows[n // 2 : n // 2 + 40] = rows[3]  # copies: ties
    rows[7] = 0
    return rows.astype(np.float32), random.integers(0, labels, n)


ODD = [(5001, None, 1), (5002, [float("nan")] * 16, 1), (5003, [None] * 16, 2), (5004, [float("inf")] + [0.0] * 15, 3), (None, [0.1] * 16, 1), (5005, [0.1] * 16, None), (5100, [1e30] * 16, 1)]


def test_query_against_brute_force(spark, folder):
    vectors, labels = sample(1_500, 16, 3)
    table = [(i, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))] + ODD
    got = sorted(map(tuple, queries.QUERIES["op11_hard_negatives"](spark, folder(embeddings=(KIND, table))).collect()))
    want = plain([(i, v, None if k is None else (k + 1) % 10 if i is not None and i % 7 == 0 else k) for i, v, k in table if i != 5100], lambda i: i % 100 == 0)
    assert got == want and len(want) > 300


@pytest.mark.parametrize("seed", [1, 2])
def test_samples_of_samples_and_small_blocks(spark, seed):
    vectors, labels = sample(900, 12, seed, 3)
    rows = [(i // 2, v.tolist(), int(k)) for i, (v, k) in enumerate(zip(vectors, labels, strict=True))]  # each id twice
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "vec_id long, embedding array<double>, label int, row int, slot string, score int")
    out = hard_negatives.mine(df, F.col("id") % 30 == 0, positives=4, negatives=6, shares=(20, 95), anchor_rows=7, block_bytes=12 * 8 * 50, first_rows=40, growth=4)
    assert sorted(map(tuple, out.collect())) == plain(rows, lambda i: i % 30 == 0, 4, 6, (20, 95))


def test_intervals_hold_every_score():
    random = np.random.default_rng(8)
    for length, turns, size in ((1, 1, 50), (3, 2, 50), (16, 1, 200), (64, 4, 500)):
        turned = hard_negatives.rotations(length, turns, 5)
        assert np.allclose(turned.T @ turned, np.eye(length))
        rows = np.floor(random.standard_normal((size, length)) * random.choice([1, 300, 1e6], (size, 1)))
        rows[0], rows[1] = 0, rows[2]
        code, align, across, norm = hard_negatives.encode(rows, turned)
        pack = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
        ids = pa.array(range(size), pa.int64())
        table = pa.table({"vector": pack(rows.astype("<i8")), "code": pack(code), "row": ids, "id": ids, "label": ids, "align": align, "across": across, "norm": norm})
        block = hard_negatives.Block(table, turned)
        for anchor in rows[:40]:
            low, high = block.interval(anchor)
            score = block.score(np.arange(size), anchor.astype(np.int64))
            assert (low <= score).all() and (score <= high).all()
            assert (score == (rows @ anchor)).all()


def test_intervals_leave_candidates_out():
    random = np.random.default_rng(8)
    rows = random.standard_normal((4_000, 64))
    rows = np.floor(rows / np.linalg.norm(rows, axis=1, keepdims=True) * 256)
    turned = hard_negatives.rotations(64, hard_negatives.ROTATIONS, 5)
    code, align, across, norm = hard_negatives.encode(rows, turned)
    pack = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
    ids = pa.array(range(len(rows)), pa.int64())
    block = hard_negatives.Block(pa.table({"vector": pack(rows.astype("<i8")), "code": pack(code), "row": ids, "id": ids, "label": ids, "align": align, "across": across, "norm": norm}), turned)
    _, high = block.interval(rows[0])
    assert (high >= 0.5 * 65_536).mean() < 0.35


def test_first_ones_with_ties():
    scores, ids = np.array([5, 9, 9, 1, 9, 5] * 20), np.arange(120)[::-1].copy()
    want = sorted(range(120), key=lambda i: (-scores[i], ids[i]))
    for k in (1, 3, 30, 200):
        assert hard_negatives.best(scores, ids, ids, k).tolist() == want[:k]


def test_empty_table_and_tables_without_pairs(spark):
    kind = "vec_id long, embedding array<float>, label int"
    empty = spark.createDataFrame([], kind)
    assert hard_negatives.mine(empty, F.col("id") % 2 == 0).isEmpty()
    alone = spark.createDataFrame([(0, [1.0, 1.0], 1), (1, [], 2), (2, None, 1)], kind)
    assert hard_negatives.mine(alone, F.col("id") % 2 == 0).isEmpty()
