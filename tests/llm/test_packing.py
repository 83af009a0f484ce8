from collections import Counter

import brute
import public_tokenizers
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from voltgrid.llm import packing, queries

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def best_fit(lengths, places):
    """Best fit, longest first, piece by piece."""
    room = []
    for n in sorted(lengths, reverse=True):
        fitting = [i for i, r in enumerate(room) if r >= n]
        if fitting:
            room[min(fitting, key=lambda i: room[i])] -= n
        else:
            room.append(places - n)
    return len(room)


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), min_size=1))
def test_plan_is_best_fit(counts):
    rows = []
    for length, runs in packing.plan_slots(counts, 30).items():
        ranks = 0
        for first, end, per, sequence, place in runs:
            assert first == ranks
            ranks = end
            rows += [(sequence + (r - first) // per, place + (r - first) % per * length, length) for r in range(first, end)]
        assert ranks == counts[length]
    assert brute.sequences_are_gapless(rows, 30)
    assert len({r[0] for r in rows}) == best_fit([n for n, c in counts.items() for _ in range(c)], 30)


def check(rows, documents, places=2048):
    expected = Counter(p for d, t in documents for p in brute.pieces(d, t, places))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    assert brute.sequences_are_gapless([(r.sequence_id, r.offset, r.length) for r in rows], places)
    assert len({r.sequence_id for r in rows}) == best_fit([r.length for r in rows], places)


def test_query_against_brute_force(spark, small, documents):
    check(queries.QUERIES["op5_pack"](spark, small).collect(), [(d, t) for d, t, *_ in documents])


def test_odd_and_repeated_rows(clashing):
    check(packing.pack(clashing.unionByName(clashing), VOCABULARY, places=64).collect(), [(r[0], r[1]) for r in ODD] * 2, 64)


def test_null_id_and_empty_table(spark, no_documents):
    rows = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    check(packing.pack(rows, VOCABULARY).collect(), [(None, "a b"), (None, None)])
    assert packing.pack(no_documents, VOCABULARY).isEmpty()
