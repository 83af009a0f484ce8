import hashlib

import brute
import numpy as np
import pytest
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from voltgrid.llm import queries, suffix_dedup


def rows_of(df):
    return sorted(
        ((r.rest.doc_id, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=str
    )


def expected(documents, width=50):
    return sorted((brute.cut_row(*row) for row in brute.cut(documents, width)), key=str)


def test_query_against_brute_force(spark, small, documents):
    rows = queries.QUERIES["op7_suffix_dedup"](spark, small).collect()
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)
    assert got == expected([(d, t) for d, t, *_ in documents])


@pytest.mark.parametrize("crowd", [2, 4_096])
def test_blocks_parts_and_crowded_minimisers(spark, documents, crowd):
    own = [(d, t) for d, t, *_ in documents[:120]]
    df = spark.createDataFrame(own, "doc_id long, text string")
    assert rows_of(suffix_dedup.remove_repeats(df, block_bytes=20_000, crowd=crowd)) == expected(own)


def test_repetitive_texts(spark):
    random = np.random.default_rng(5)
    words = ["aa", "b", "ab", "aaa"]
    own = [(int(i), "".join(random.choice(words, random.integers(0, 60)))) for i in range(150)]
    own += [(200, "ab" * 300), (201, "ab" * 300), (202, "é" * 100), (203, "xé" + "é" * 90)]
    df = spark.createDataFrame(own, "doc_id long, text string")
    assert rows_of(suffix_dedup.remove_repeats(df, width=24, block_bytes=1_000, crowd=5)) == expected(own, 24)


def test_odd_rows_and_clashing_names(clashing):
    out = suffix_dedup.remove_repeats(clashing)
    assert rows_of(out) == expected([(r[0], r[1]) for r in ODD])
    assert out.select("rest.*").columns == [c for c in clashing.columns if c != "text"]


def test_spans_are_the_removed_bytes(spark):
    passage = "this passage of the text is longer than fifty bytes, surely it is."
    own = [(1, passage), (2, f"before {passage} between {passage} after"), (3, "x" + passage[5:])]
    rows = {r.rest.doc_id: r for r in suffix_dedup.remove_repeats(spark.createDataFrame(own, "doc_id long, text string")).collect()}
    assert bytes(rows[2].kept) == b"before  between  after"
    assert [(s.start, s.length) for s in rows[2].spans] == [(7, len(passage)), (16 + len(passage), len(passage))]
    assert bytes(rows[3].kept) == b"x" and bytes(rows[1].kept).decode() == passage


def test_equal_and_null_ids(spark):
    own = [(None, "k" * 60), (None, "k" * 60), (5, "m" * 60), (5, "m" * 60), (6, "k" * 70)]
    df = spark.createDataFrame(own, "doc_id long, text string")
    assert rows_of(suffix_dedup.remove_repeats(df)) == expected(own)


def test_rows_equal_in_id_and_text_spread_over_blocks(spark, monkeypatch):
    passage = "a passage of more than fifty bytes that all of these rows have in common"
    own = [(None, passage + " and no id")] * 200 + [(5, "five: " + passage)] * 200 + [(i, f"{i} {passage} {i}") for i in (4, 6, 7)] + [(None, None)] * 100
    sizes, remove = [], suffix_dedup.remove_path

    def look(spark, path):
        sizes.extend(spark.read.parquet(path).groupBy("block").agg({"text": "count"}).toPandas()["count(text)"])
        remove(spark, path)

    monkeypatch.setattr(suffix_dedup, "remove_path", look)
    df = spark.createDataFrame(own, "doc_id long, text string")
    assert rows_of(suffix_dedup.remove_repeats(df, block_bytes=4_000)) == expected(own)
    assert sum(sizes) == len(own) and max(sizes) < 120


def test_empty_table(no_documents):
    assert suffix_dedup.remove_repeats(no_documents).isEmpty()


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=300), st.integers(1, 6))
def test_column_order_sorts_strings(data, letters):
    data = np.frombuffer(data, np.uint8) % letters
    starts = np.arange(max(0, len(data) - 9))
    order, same = suffix_dedup.column_order(data, starts, 10)
    strings = [data[s : s + 10].tobytes() for s in order]
    assert strings == sorted(strings)
    assert [a == b for a, b in zip(strings, strings[1:], strict=False)] == [a == b for a, b in zip(same.tolist(), same.tolist()[1:], strict=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(max_size=120), max_size=6))
def test_equal_strings_have_equal_minimisers(texts):
    texts = [bytes(b % 3 for b in t) for t in texts]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts]).astype(np.int64)
    starts, counts, keys = suffix_dedup.stretches(data, ends, 30)
    whole, seen, found = data.tobytes(), {}, set()
    for start, count, key in zip(starts.tolist(), counts.tolist(), keys.tolist(), strict=True):
        for s in range(start, start + count):
            found.add(s)
            assert seen.setdefault(whole[s : s + 30], key) == key
    begins = [0, *ends.tolist()[:-1]] if texts else []
    assert found == {s for a, b in zip(begins, ends.tolist(), strict=True) for s in range(a, b - 29)}
