"""Byte-level BPE against the tiktoken library, and decoding as an exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltgrid.llm import byte_bpe, queries

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={})


def library_words(text):
    import regex

    return [m.group() for m in regex.finditer(public_tokenizers.PATTERN, text)]


def own_words(texts):
    known, places = byte_bpe.number_words(pa.array([t.encode() for t in texts], pa.binary()))
    known = known.to_pylist()
    return [[known[c].decode() for c in codes] for codes in places.to_pylist()]


MIXED = st.text(st.one_of(st.sampled_from("'''  \n\t  sstrevelmd aé1²½ſ!?_数😀 　́"), st.characters(exclude_categories=["Cs"])), max_size=40)


@settings(max_examples=400, deadline=None)
@given(st.lists(MIXED, max_size=6))
def test_ids_are_those_of_the_library(texts):
    piece = byte_bpe._encoder(PATH)
    assert [[x for w in words for x in piece(w.encode())] for words in own_words(texts)] == [LIBRARY.encode_ordinary(t) for t in texts]


def test_words_of_every_character_and_of_contractions():
    # all characters of the planes that have letters, and some of the rest
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x34000 or c % 64 == 0 or 0xE0000 <= c < 0xE0200)]
    text = "".join(f"a{c}b1{c}2 {c}!{c} \n{c}" for c in every)
    known, places = byte_bpe.number_words(pa.array([text.encode()], pa.binary()))
    piece = byte_bpe._encoder(PATH)
    ids = [piece(w) for w in known.to_pylist()]
    assert [x for c in places.values.to_pylist() for x in ids[c]] == LIBRARY.encode_ordinary(text)
    random.seed(5)
    parts = ["'", "s", "t", "re", "ve", "ll", "l", "d", "m", " ", "\n", "x", "'s", "1", "É", "."]
    texts = ["".join(random.choices(parts, k=12)) for _ in range(10_000)]
    assert own_words(texts) == [library_words(t) for t in texts]


def digests(text):
    ids = LIBRARY.encode_ordinary(text or "")
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()


def test_query_against_the_library(spark, small, documents):
    got = queries.QUERIES["op12_byte_bpe"](spark, small).collect()
    assert {r.doc_id: tuple(r)[1:] for r in got} == {d: digests(t) for d, t, *_ in documents}
    assert len(got) == len(documents)


@pytest.mark.parametrize("block_bytes", [1, 4_000, 1 << 20])
def test_odd_rows_in_blocks_of_any_size(spark, clashing, block_bytes):
    rows = clashing.unionByName(clashing).unionByName(clashing.withColumn("doc_id", F.lit(None).cast("long")))
    out = byte_bpe.encode(rows.coalesce(2), PATH, keep=["doc_id", "ids", "block"] if "ids" in rows.columns else ["doc_id", "block"], block_bytes=block_bytes)
    got = sorted((str(r.doc_id), str(r.block), list(r.ids)) for r in out.collect())
    block = clashing.first()["block"]
    want = [(str(d), str(block), LIBRARY.encode_ordinary(t or "")) for r in ODD for d, t in ((r[0], r[1]),) * 2 + ((None, r[1]),)]
    assert got == sorted(want)


def test_long_words_and_texts(spark):
    random.seed(1)
    texts = ["".join(random.choices("abcdefgh", k=120_000)), " " * 50_000, "\n" * 9_999 + "x", "'" * 1_001, "word " * 90_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = byte_bpe.encode(df, PATH).withColumn("decoded", byte_bpe.decode(F.col("ids"), PATH)).collect()
    assert {r.doc_id: list(r.ids) for r in out} == {i: LIBRARY.encode_ordinary(t) for i, t in enumerate(texts)}
    assert all(bytes(r.decoded).decode() == texts[r.doc_id] for r in out)


def test_decoding_of_odd_lists_and_of_an_empty_table(spark, no_documents):
    lists = [[], None, [0, 50_255], [50_256], [1, None], [-1], [256, 257, 258]]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lists)], "n int, ids array<int>")
    got = {r.n: r.b for r in df.select("n", byte_bpe.decode(F.col("ids"), PATH).alias("b")).collect()}
    assert {k: v if v is None else bytes(v) for k, v in got.items()} == {
        i: None if x is None or any(y is None or not 0 <= y < 50_256 for y in x) else LIBRARY.decode_bytes(x) for i, x in enumerate(lists)
    }
    assert byte_bpe.encode(no_documents, PATH).isEmpty()


def test_bytes_that_are_no_character_come_back():
    broken = [b"\xff\xfe abc\xc3", b"\x80\x80", b"\xf0\x9f", b"a\xe2\x82 b", b"\xf8\x88\x80\x80\x80"]
    known, places = byte_bpe.number_words(pa.array(broken, pa.binary()))
    known = known.to_pylist()
    assert [b"".join(known[c] for c in codes) for codes in places.to_pylist()] == broken
    assert byte_bpe.word_starts(np.frombuffer(b"\x80", np.uint8), np.array([0])).tolist() == [0]
