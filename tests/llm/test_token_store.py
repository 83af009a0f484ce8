import functools
import glob

import brute
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from voltgrid.llm import queries, token_store
from voltgrid.llm.encoding import Encoder

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@functools.cache
def forgetful():
    return Encoder(VOCABULARY, words=10)


def expected(rows, end=2):
    out, start = {}, 0
    for d, text in sorted(rows):
        ids = brute.token_ids(text, end)
        out[d] = (start, len(ids), brute.crc(ids))
        start += len(ids)
    return out


def test_query_against_the_library(spark, small, documents):
    rows = queries.QUERIES["op1_token_store"](spark, small).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == expected([(d, t) for d, t, *_ in documents])
    assert len(rows) == len(documents)


def test_odd_rows_and_ranges(spark, clashing, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(clashing, path, VOCABULARY)
    want = expected([(r[0], r[1]) for r in ODD])
    got = token_store.checksums(token_store.read_store(spark, path)).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want
    some = token_store.read_store(spark, path, first=2, last=5, ids=False)
    assert some.columns == ["doc_id", "start", "n_tokens"]
    assert {r.doc_id: (r.start, r.n_tokens) for r in some.collect()} == {d: want[d][:2] for d in (2, 3, 4, 5)}
    ids = {r.doc_id: r.ids for r in token_store.read_store(spark, path, first=6, last=6).collect()}
    assert ids == {6: brute.token_ids(ODD[5][1], 2)}


def test_file_layout(spark, odd, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(odd, path, VOCABULARY)
    names = sorted(glob.glob(f"{path}/tokens/part-*.parquet"))
    last = None
    for name in names:
        group = pq.ParquetFile(name).metadata
        for g in range(group.num_row_groups):
            columns = {group.row_group(g).column(c).path_in_schema: group.row_group(g).column(c) for c in range(group.num_columns)}
            ids = columns["ids.list.element"]
            assert any("DICTIONARY" in e for e in ids.encodings)
            assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and "DELTA_BINARY_PACKED" in columns["start"].encodings
            assert ids.has_offset_index and columns["doc_id"].has_column_index
        own = pq.read_table(name, columns=["doc_id"]).column(0).to_pylist()
        assert own == sorted(own) and (last is None or not own or own[0] >= last)
        last = own[-1] if own else last


def test_null_ids_repeated_rows_and_empty_table(spark, odd, no_documents, tmp_path):
    rows = spark.createDataFrame([(None, "a"), (1, "b c"), (1, "b c"), (1, "a")], "doc_id long, text string")
    token_store.write_store(rows, str(tmp_path / "a"), VOCABULARY)
    got = sorted((r.start, r.n_tokens, r.doc_id) for r in token_store.read_store(spark, str(tmp_path / "a")).collect())
    assert got == [(0, 2, None), (2, 2, 1), (4, 3, 1), (7, 3, 1)]
    token_store.write_store(no_documents, str(tmp_path / "b"), VOCABULARY)
    assert token_store.read_store(spark, str(tmp_path / "b")).isEmpty()


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aAéÉ's.,\n\t 1½ΣςİßΩǅ<|endoftext|>  ́"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_chunks_give_the_ids_of_the_whole(text):
    codes = forgetful()
    assert list(memoryview(codes.ids(text.encode())).cast("I")) == brute.token_ids(text, 0)[:-1]


def test_every_letter_alone_after_a_letter_and_before_a_mark():
    """Also letters that come apart when they are normalised, and those that a lower case has several of."""
    codes = Encoder(VOCABULARY)
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x20000 or c % 256 == 0)]
    text = "\n".join(f"{c} a{c} {c}. {c}b a{c}\u0301," for c in every)
    assert list(memoryview(codes.ids(text.encode())).cast("I")) == brute.token_ids(text, 0)[:-1]
    for word in ("হয়", "সময়", "सड़क", "पढ़.", "שׁלום"):
        assert list(memoryview(codes.ids(word.encode())).cast("I")) == brute.token_ids(word, 0)[:-1]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aé \n.!'1<|endoftext|>", max_size=12), max_size=8))
def test_texts_of_a_batch_stay_apart(texts):
    codes = forgetful()
    got = []
    for _, ids, ends in codes.encode(pa.array([t.encode() for t in texts], pa.binary()), 2):
        got += [ids[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    assert got == [brute.token_ids(t, 2) for t in texts]
