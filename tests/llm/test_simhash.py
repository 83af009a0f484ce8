import itertools

import brute
import numpy as np
import pytest
from conftest import ODD

from voltgrid.llm import queries, simhash
from voltgrid.llm.components import connected_components


def test_query_against_brute_force(spark, small, documents):
    rows = queries.QUERIES["op6_simhash_near_dedup"](spark, small).collect()
    expected = brute.simhash_components([(d, t) for d, t, *_ in documents])
    assert {r.doc_id: (int(r.fingerprint, 16), r.component_id) for r in rows} == expected and len(rows) == len(expected)


def test_odd_rows(clashing):
    rows = simhash.near_copies(clashing).collect()
    assert {r.doc_id: (r.fingerprint % 2**64, r.component_id) for r in rows} == brute.simhash_components([(r[0], r[1]) for r in ODD])


@pytest.mark.parametrize("n", [0, 40, 5_000, 10**9])
def test_thresholds_keep_the_pigeonhole(n):
    both = np.full((64, 64), n / 4) + np.diag(np.full(64, n / 4))
    for limit in (0, 1, 3, 4, 7):
        parts = simhash.plan(both, n, limit)
        assert sum(t + 1 for _, t in parts) == limit + 1
        bits = [b for own, _ in parts for b in own]
        assert len(bits) == len(set(bits))


def test_links_of_close_fingerprints(spark):
    random = np.random.default_rng(3)
    base = random.integers(0, 2**63, 40, dtype=np.uint64)
    near = [b ^ np.uint64(sum(1 << int(i) for i in random.choice(64, d, replace=False))) for b in base for d in range(7)]
    prints = sorted({int(p) for p in near})
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fingerprint long")
    got = {(r.a % 2**64, r.b % 2**64) for r in simhash.links(df, 4).collect()}
    expected = {(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 4}
    assert {tuple(sorted(p)) for p in got} == expected


def test_components_of_chains_stars_and_pairs(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(7, 200 + i) for i in range(50)] + [(1, 1), (300, 301), (301, 300), (-5, 300)]
    df = spark.createDataFrame([*links, (None, 3), (3, None)], "a long, b long")
    got = {r.node: r.root for r in connected_components(df).collect()}
    nodes = {n for a, b in links if a != b for n in (a, b)}
    assert got == brute.components(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(df.limit(0)).isEmpty()


def test_first_of_each_group(spark, clashing):
    kept = simhash.first_of_each(clashing.unionByName(clashing), simhash.near_copies(clashing.unionByName(clashing)))
    expected = {d for d, (_, c) in brute.simhash_components([(r[0], r[1]) for r in ODD]).items() if d == c}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected) and kept.columns == clashing.columns


def test_null_ids_and_equal_ids(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (4, "a b c d e"), (4, "q r s t u v"), (None, "z y x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    groups = simhash.near_copies(df)
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in groups.collect()) == [(0, 0), (0, 4), (0, 4), (4, 4), (4, 4)]
    kept = simhash.first_of_each(df, groups).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "z y x"), (4, "a b c d e"), (4, "q r s t u v")]


def test_empty_table(no_documents):
    groups = simhash.near_copies(no_documents)
    assert groups.isEmpty() and simhash.first_of_each(no_documents, groups).isEmpty()
