"""Language identification and token counts."""

import random
import time
import zlib

import public_tokenizers
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltgrid.llm import language, queries, token_counts

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_automaton_against_sets_of_substrings():
    pick = random.Random(1)
    for _ in range(300):
        words = ["".join(pick.choice("abc") for _ in range(pick.randint(1, 8))) for _ in range(5)]
        automaton = language.SuffixAutomaton()
        for w in words:
            automaton.add(w)
        known = {w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1)}
        text, count, at = "".join(pick.choice("abcd") for _ in range(20)), 0, 0
        while at < len(text):
            end = at + 1
            while end < len(text) and text[at:end] in known and text[at : end + 1] in known:
                end += 1
            count, at = count + 1, end
        assert automaton.phrases(text) == count


def test_query_on_held_out_rows(spark, small, documents):
    rows = {r.doc_id: r for r in queries.QUERIES["op9_language"](spark, small).collect()}
    assert len(rows) == len(documents)
    held = [(d, lang) for d, _, lang, _ in documents if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d, r in rows.items() if r.held_out} == {d for d, _ in held}
    assert sum(rows[d].lang_pred == lang for d, lang in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_predictions_use_the_text_alone(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    samples = language.fit(docs)
    found = lambda df: {r.text: tuple(r.f) for r in df.select("text", language.identify(df, F.col("text"), samples).alias("f")).collect()}
    assert found(docs) == found(docs.select("text", F.lit(0).alias("doc_id"), F.lit("xx").alias("lang")))


def test_odd_rows(spark, small, clashing, no_documents):
    samples = language.fit(spark.read.parquet(f"{small}/documents.parquet"))
    rows = {r.doc_id: r.f for r in clashing.select("doc_id", language.identify(clashing, F.col("text"), samples).alias("f")).collect()}
    assert {d for d, f in rows.items() if f.lang == "und"} == {1, 2, 4, 9}
    assert rows[1].score == 0 and rows[11].lang == "de" and rows[-4].lang == "es"
    assert language.fit(no_documents) == {}
    nothing = clashing.select(language.identify(clashing, F.col("text"), {}).alias("f"))
    assert {r.f.lang for r in nothing.collect()} == {"und"}
    assert no_documents.select(language.identify(no_documents, F.col("text"), samples)).isEmpty()


def test_fit_is_bounded_and_repeatable(spark, small, odd):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    a, b = language.fit(docs), language.fit(docs.repartition(7))
    assert a == b and all(sum(map(len, w)) < language.SAMPLE_LETTERS + 100 for w in a.values())
    assert set(language.fit(odd)) == {"en", "fr", "de", "es"}


def test_fit_takes_no_more_rows_of_an_id_than_of_a_language(spark):
    word = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))
    rows = [(7, word(i), "en") for i in range(3 * language.SAMPLE_DOCS)] + [(7, "mot", "fr"), (8, "autre", "fr")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    a, b = language.fit(docs), language.fit(docs.repartition(5, "text"))
    assert a == b and sorted(a["fr"]) == ["autre", "mot"]
    assert sorted(a["en"]) == sorted(word(i) for i in range(3 * language.SAMPLE_DOCS))[: language.SAMPLE_DOCS]


def plain_count(word, scores, spelled):
    best = [(0, 0)]
    for end in range(1, len(word) + 1):
        n = len(word[end - 1].encode())
        options = [(best[end - 1][0] + n * spelled, best[end - 1][1] - n)]
        options += [(best[a][0] + scores[word[a:end]], best[a][1] - 1) for a in range(end) if word[a:end] in scores]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_against_plain_segmentation(spark, small, documents):
    scores = token_counts.zipf_scores(token_counts.sentencepiece_pieces(PIECES))
    spelled = min(scores.values()) - 1_000_000
    known = {}
    rows = {r.doc_id: r for r in queries.QUERIES["op8_token_counts"](spark, small).collect()}
    assert len(rows) == len(documents)
    for d, text, *_ in documents[:80]:
        words = [w.decode() for w in text.encode().split()]
        for w in words:
            if w not in known:
                known[w] = plain_count("▁" + w, scores, spelled)
        assert (rows[d].n_pretokens, rows[d].n_tokens) == (len(words), sum(known[w] for w in words))


def test_token_counts_of_odd_rows(clashing, no_documents):
    rows = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(clashing, PIECES).collect()}
    assert len(rows) == len(ODD) and rows[1] == rows[2] == rows[4] == (0, 0) and rows[3] == rows[8]
    assert rows[7][0] == 3 and rows[11][0] == 24_000
    assert token_counts.count_tokens(no_documents, PIECES).isEmpty()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab▁é", max_size=9), max_size=8))
def test_trie_gives_the_same_as_plain_segmentation(words):
    scores = token_counts.zipf_scores(["a", "b", "ab", "aba", "▁", "▁a", "bb", "abab", "▁ab"])
    counter = token_counts.TrieCounter(scores, nodes=5)
    for word in words:
        expected = plain_count("▁" + word, scores, min(scores.values()) - 1_000_000)
        assert counter.count(word.encode())[1] == (expected if word else 0)


def test_a_long_piece_does_not_slow_other_words():
    scores = token_counts.zipf_scores(["a", "b", "ab", "c" * 6_000])
    begin = time.process_time()
    counter = token_counts.TrieCounter(scores)
    assert counter.count(b"ab" * 10_000)[1] == 10_003
    assert time.process_time() - begin < 5
