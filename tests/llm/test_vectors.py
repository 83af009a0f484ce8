"""Nearest neighbours and near copies of vectors."""

import brute
import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from voltgrid.llm import hashing_search, queries, vector_dedup

KIND = [("vec_id", pa.int64()), ("embedding", pa.list_(pa.float32())), ("label", pa.int32())]


def unit(rows):
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def sample(n=900, length=24, seed=2):
    """Random vectors, groups of near copies of several sizes, exact copies."""
    random = np.random.default_rng(seed)
    rows = unit(random.standard_normal((n, length)))
    at = 0
    for size in (2, 2, 3, 5, 9, 40, 150):
        rows[at : at + size] = unit(rows[at] + random.standard_normal((size, length)) * 0.055)
        at += size
    rows[at : at + 60] = rows[at]
    return random.permutation(rows.astype(np.float32)), random.integers(0, 3, n)


ODD = [(1001, None, 1), (1002, [0.0] * 24, 1), (1003, [float("nan")] * 24, 1), (1004, [1.0, None] + [0.0] * 22, 1), (1005, [float("inf")] + [1.0] * 23, 1), (1006, [1.0], 1), (1007, [], None), (1020, [0.0] * 24, 0)]


def links_of(rows, labels, threshold):
    rows = unit(rows.astype(np.float64))
    close = (rows @ rows.T >= threshold) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(close, False)
    return close


def test_near_copies_against_brute_force(spark, folder):
    rows, labels = sample()
    table = [(i, r.tolist(), int(k)) for i, (r, k) in enumerate(zip(rows, labels, strict=True))] + ODD + [(1030, rows[0].tolist(), None)]
    got = {r.vec_id: r for r in queries.QUERIES["op10_vector_dedup"](spark, folder(embeddings=(KIND, table))).collect()}
    assert len(got) == len(table)
    close = links_of(rows, labels, 0.93)
    expected, found = close.sum(1), np.array([got[i].n_links for i in range(len(rows))])
    assert (found <= expected).all() and found.sum() >= 0.99 * expected.sum() and expected.max() > 30
    roots = brute.components(range(len(rows)), zip(*map(np.ndarray.tolist, np.nonzero(close)), strict=True))
    assert np.mean([got[i].component_id == roots[i] for i in range(len(rows))]) >= 0.99
    assert all(got[i].kept == (got[i].component_id == i) for i in got)
    for i, *_ in [*ODD, (1030,)]:
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)


def test_repeated_rows_null_ids_and_empty_table(spark):
    schema = "vec_id long, embedding array<float>, label int, vector string, id int, n int, first int"
    rows = [(5, [1.0, 0.0], 1), (5, [1.0, 0.0], 1), (None, [1.0, 0.01], 1), (7, [2.0, 0.0], 1), (9, [0.0, 1.0], 1), (None, None, None)]
    df = spark.createDataFrame([(*r, "x", 1, 1, 1) for r in rows], schema)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id or 0, r.kept) for r in vector_dedup.near_copies(df, 0.93).collect())
    assert got == [(0, 0, 0, False), (0, 3, 5, False), (5, 3, 5, True), (5, 3, 5, True), (7, 3, 5, False), (9, 0, 9, True)]
    assert vector_dedup.near_copies(df.limit(0), 0.93).isEmpty()


def test_traversal_is_in_order_of_distance():
    random = np.random.default_rng(1)
    first, second = np.sort(random.random(7)), np.sort(random.random(5))
    sums = [first[i] + second[j] for i, j in vector_dedup.traverse(first, second)]
    assert len(sums) == 35 and sums == sorted(sums)


def recall(got, rows, ids, queries_, k):
    hits = []
    for q in queries_:
        scores = rows.astype(np.float64) @ rows[q].astype(np.float64)
        order = [i for i in np.lexsort((ids, -scores)) if i != q][:k]
        own = sorted(got.get(int(ids[q]), []))
        assert [r for r, *_ in own] == list(range(1, len(order) + 1))
        assert all(abs(scores[np.flatnonzero(ids == v)[0]] - s) < 1e-9 for _, v, s in own)
        assert [s for *_, s in own] == sorted((s for *_, s in own), reverse=True) and int(ids[q]) not in [v for _, v, _ in own]
        hits.append(len({int(ids[i]) for i in order} & {v for _, v, _ in own}) / len(order))
    return np.mean(hits)


def by_query(rows):
    out = {}
    for r in rows:
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def test_search_against_brute_force(spark, folder):
    rows, labels = sample(3_000, 32, 4)
    rows = rows * np.linspace(0.5, 2, len(rows))[:, None].astype(np.float32)
    table = [(i, r.tolist(), int(k)) for i, (r, k) in enumerate(zip(rows, labels, strict=True))]
    odd = [(i + 5_000, [0.0] * 32 if v and len(v) == 24 else v, k) for i, v, k in ODD]
    got = by_query(queries.QUERIES["op2_hashing_search"](spark, folder(embeddings=(KIND, table + odd))).collect())
    asked = [i for i in range(len(rows)) if i % 20 == 0]
    assert set(got) == set(asked)
    assert recall(got, rows, np.arange(len(rows)), asked, 20) >= 0.9


def test_search_returns_all_where_there_are_few(spark):
    df = spark.createDataFrame([(i, [float(i + 1), 1.0], "x") for i in range(5)] + [(0, [1.0, 1.0], "x"), (None, [9.0, 9.0], "y")], "vec_id long, embedding array<double>, code string")
    rows = sorted(tuple(r) for r in hashing_search.search(df, F.col("id") % 20 == 0, k=3).collect())
    assert rows == [(0, 1, 4, 6.0), (0, 2, 3, 5.0), (0, 3, 2, 4.0)]
    assert len(hashing_search.search(df, F.col("id") % 20 == 0, k=20).collect()) == 4
    assert hashing_search.search(df.limit(0), F.col("id") % 20 == 0).isEmpty()


def test_every_code_within_the_radius_is_retrieved():
    random = np.random.default_rng(9)
    for parts in (1, 2, 4):
        a, b = (random.integers(0, 2**32, (4_000, parts), dtype=np.uint32) & random.integers(0, 2**32, (4_000, parts), dtype=np.uint32) for _ in range(2))
        apart = np.bitwise_count(a ^ b).astype(int)
        for radius in (0, 3, 10, 30, 60):
            limits = hashing_search.allowed(np.array([radius]), parts)
            near = apart.sum(1) <= radius
            assert (apart[near] <= limits).any(1).all()


def test_far_blocks_give_only_what_reaches_the_floor():
    random = np.random.default_rng(4)
    rows = unit(random.standard_normal((300, 8)))
    coder = hashing_search.Coder(rows, 1.0, len(rows), 20)
    codes = [c.tobytes() for c in coder.codes(coder.lifted(rows))]
    index = pa.table({"id": np.arange(300), "vector": [r.tobytes() for r in rows], "code": codes, "part": np.zeros(300, np.int32)})
    scores = np.sort(rows @ rows[0])[::-1]
    asked = {"id": [1000, 1001], "vector": [rows[0].tobytes()] * 2, "code": [coder.query_codes(rows[:1])[0].tobytes()] * 2, "radius": [128, 128]}
    queries_ = pa.table({**asked, "floor": [(scores[4] + scores[5]) / 2, float("-inf")]})
    found = hashing_search._probe("<f8", 8, 4, 20)(index, queries_).to_pydict()
    assert found["query_id"].count(1000) == 5 and found["query_id"].count(1001) == 20
    assert np.allclose([s for q, s in zip(found["query_id"], found["score"], strict=True) if q == 1000], scores[:5])


def test_turns_over_blocks_find_the_same(spark, monkeypatch):
    rows, _ = sample(600, 16)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<float>")
    found = []
    for block in (8_192, 100):
        monkeypatch.setattr(hashing_search, "INDEX_ROWS", block)
        found.append(sorted(map(tuple, hashing_search.search(df, F.col("id") % 20 == 0).collect())))
    assert found[0] == found[1] and len(found[0]) == 30 * 20
