from collections import Counter

import brute
from pyspark.sql import functions as F

import corpus_pipeline
from voltgrid.llm import queries

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def plain_run(documents):
    """All stages on (doc_id, text, lang, source) with distinct ids; pieces as `brute.pieces` gives them."""
    docs = [(d, text, source) for d, text, _, source in documents if any(map(str.isalpha, text or ""))]
    groups = brute.simhash_components([(d, t) for d, t, _ in docs])
    docs = [(d, t, s) for d, t, s in docs if groups[d][1] == d]
    source = {d: s for d, _, s in docs}
    cut = []
    for d, b, mask in brute.cut([(d, t) for d, t, _ in docs]):
        if not len(b) or not mask.all():
            cut.append((d, bytes(x for x, gone in zip(b, mask, strict=True) if not gone).decode("utf-8", "ignore"), source[d]))
    taken = {d: row for d, row in brute.mix(cut).items()}
    pieces = Counter()
    for d, text, _ in cut:
        size, _, _, many = taken[d]
        for _ in range(many // size if size else 0):
            pieces.update(brute.pieces(d, text))
        if size and many % size:
            pieces.update(brute.pieces(d, " ".join(brute.words(text)[: many % size])))
    return pieces


def test_run_against_brute_force(spark, small, documents):
    rows = corpus_pipeline.run(spark, small).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == plain_run(documents)
    assert brute.sequences_are_gapless([(r.sequence_id, r.offset, r.length) for r in rows], 2048)


def test_stages_on_odd_rows(spark, clashing, tmp_path):
    docs = clashing.unionByName(clashing).unionByName(clashing.withColumn("doc_id", F.lit(None).cast("long")))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        out.write.parquet(str(tmp_path / name))
        out = spark.read.parquet(str(tmp_path / name))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == clashing.columns
            docs = out
        assert out.count() > 0


def test_stages_on_an_empty_table(spark, no_documents):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, no_documents, "")
        assert out.isEmpty()
        assert name == "best_fit_packing" or out.columns == COLUMNS


def test_stages_are_the_registered_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "simhash_near_dedup", "suffix_array_dedup", "mix_sources", "best_fit_packing"]
    assert sorted(int(q.split("_")[0][2:]) for q in queries.QUERIES) == list(range(1, 14))


def test_language_stage_rejects_texts_without_letters_alone(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    top = docs.agg(F.max("doc_id")).first()[0]
    texts = ["A.", "A.\nAll rights reserved.", "I", "a b c", "été", "数", "", None, " 12 -- !", "_9_"]
    short = spark.createDataFrame([(top + 1 + i, t, "en") for i, t in enumerate(texts)], docs.schema)
    both = docs.unionByName(short)
    kept = {r.doc_id for r in corpus_pipeline.identify_language(spark, both, "").select("doc_id").collect()}
    assert kept == {r.doc_id for r in both.collect() if any(map(str.isalpha, r.text or ""))}


def test_replacement_characters_of_the_text_stay(spark):
    passage = "é" + "a passage of more than fifty bytes that two texts share" + "é"
    other = passage.replace("é", "è")  # its last character begins as é does: the cut leaves the second half
    half = "©" + passage[1:]  # its first character ends as é does: the cut leaves the first half
    own = [(1, passage), (2, f"\ufffdone \x01b {passage} \ufffd\x01 two\ufffd"), (3, f"\ufffd {other}\ufffd"), (4, f"\x01\ufffd{half} \x01a")]
    docs = spark.createDataFrame(own, "doc_id long, text string")
    got = {r.doc_id: r.text for r in corpus_pipeline.drop_repeats(spark, docs, "").collect()}
    left = {d: bytes(x for x, gone in zip(b, mask, strict=True) if not gone).decode("utf-8", "ignore") for d, b, mask in brute.cut(own)}
    assert got == left
    assert got[2] == "\ufffdone \x01b  \ufffd\x01 two\ufffd" and got[3].count("\ufffd") == 2


def test_partial_characters_go_as_in_a_decoder_that_ignores_them(spark):
    own = [b"\xc3", b"a\xc3b", b"\xa9\x01\xef\xbf\xbd\x01a", b"\x01b\xe2\x82\xef\xbf\xbd\xf0\x9f", b"\xf0\x9f\x98\x80\x01\x01b\xff", b"\xef\xbf", b"\x01ab\x01", b""]
    rows = spark.createDataFrame([(b,) for b in own], "b binary").select("b", corpus_pipeline.without_partial_characters(F.col("b").cast("string")).alias("t")).collect()
    assert {bytes(r.b): r.t for r in rows} == {b: b.decode("utf-8", "ignore") for b in own}
