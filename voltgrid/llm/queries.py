"""The operators bound to the test tables: one query each over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from . import byte_bpe, fill_middle, hard_negatives, hashing_search, language, licenses, mixing, packing, simhash, suffix_dedup, token_counts, token_store, vector_dedup
from .common import shared_path, stored

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_token_store")
def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    path = shared_path(spark, "tokens")
    token_store.write_store(table(spark, folder, "documents"), path, VOCABULARY)
    return token_store.checksums(token_store.read_store(spark, path))


@query(
    "op3_mix_sources",
    r"""
    WITH sized AS (
        SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
            greatest(coalesce(length(regexp_replace(text, '[^\p{L}]+', '', 'g')) / greatest(length(text), 1), 0.0), 0.25) AS quality
        FROM documents
    ), sources AS (
        SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rank
        FROM sized GROUP BY source
    ), limits AS (
        SELECT *, [5.0, 2.0, 1.0][(rank - 1) % 3 + 1]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS cap FROM sources
    ), levels AS (
        SELECT *, cap / weight AS per_weight,
            (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
        FROM limits
    ), targets AS (
        SELECT *, least(cap, weight * (SELECT min_by(level, rank_of) FROM (
            SELECT level, row_number() OVER (ORDER BY per_weight, rank) AS rank_of, per_weight FROM levels) WHERE level <= per_weight)) AS target
        FROM levels
    ), keyed AS (
        SELECT d.doc_id, d.size, t.source_size, t.target, t.rank, floor(t.target / greatest(t.source_size, 1))::BIGINT AS epochs,
            floor(t.target + 0.5)::BIGINT - floor(t.target / greatest(t.source_size, 1))::BIGINT * t.source_size AS rest,
            -ln((('0x' || md5('17:' || d.doc_id)[:13])::BIGINT + 0.5) / 4503599627370496.0::DOUBLE) / d.quality AS key
        FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
    ), summed AS (
        SELECT *, coalesce(sum(size) OVER (PARTITION BY rank ORDER BY key, doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead FROM keyed
    )
    SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - ahead)))::BIGINT AS taken FROM summed
    """,
)
def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    from .common import stored

    documents = stored(mixing.sized(table(spark, folder, "documents")), "sized")
    return mixing.mix(documents, mixing.targets(documents)).drop("source", "text_hash")


@query("op5_pack")
def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), VOCABULARY)


@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    groups = simhash.near_copies(table(spark, folder, "documents"), shingle=4, limit=4, seed=42)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, folder, "documents"), PIECES)


@query("op9_language")
def op9_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    samples = language.fit(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language.identify(docs, F.col("text"), samples).alias("found"))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))


@query("op4_license_scan", licenses.check_sql())
def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, folder, "documents"), width=50).select(
        "rest.doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query("op2_hashing_search")
def op2_hashing_search(spark: SparkSession, folder: str) -> DataFrame:
    return hashing_search.search(table(spark, folder, "embeddings"), F.col("id") % 20 == 0, k=20)


@query("op10_vector_dedup")
def op10_vector_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_dedup.near_copies(table(spark, folder, "embeddings"), threshold=0.93)


@query("op11_hard_negatives")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, folder, "embeddings").withColumn("label", moved), F.col("id") % 100 == 0)


@query("op12_byte_bpe")
def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    encoded = byte_bpe.encode(table(spark, folder, "documents"), RANKS)
    decoded = encoded.withColumn("decoded", byte_bpe.decode(F.col("ids"), RANKS))
    digits = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(digits, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


@query(
    "op13_fill_middle",
    r"""
    WITH cut AS (
        SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS ls,
            sha256('7:' || doc_id) AS h FROM documents
    ), drawn AS (
        SELECT *, len(ls)::BIGINT AS n, ('0x' || h[1:8])::BIGINT % (len(ls) + 1) AS a, ('0x' || h[9:16])::BIGINT % (len(ls) + 1) AS b,
            ('0x' || h[17:24])::BIGINT % 100 AS c, ('0x' || h[25:32])::BIGINT % 100 AS d FROM cut
    ), parts AS (
        SELECT *, array_to_string(ls[1:least(a, b)], '') AS p, array_to_string(ls[least(a, b) + 1:greatest(a, b)], '') AS m,
            array_to_string(ls[greatest(a, b) + 1:], '') AS s,
            CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR c >= 100 THEN 'plain'
                 WHEN d < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn
    )
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
        CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
        sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                         WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
        sha256(t) AS restored_sha256
    FROM parts
    """,
)
def op13_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_middle.rearrange(table(spark, folder, "documents"))
    return cut.select(
        "rest.doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )
