"""A training corpus from ``documents``: language, near copies, repeated passages, mix, packed sequences.

`STAGES` are functions of (spark, docs, folder) that return a DataFrame; each works on
all that its predecessor kept, as stored rows.  All but the last return the columns of
``documents``.

Every stage copes with nulls in any column, empty and very long texts, repeated rows,
empty tables and further columns, as its operator's docstring states.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltgrid.llm import language, mixing, packing, simhash, suffix_dedup
from voltgrid.llm.common import stored

#: characters that stand as escapes while partial characters are dropped, the escapes' first one before all
ESCAPES = [("\x01", "\x01a"), ("\ufffd", "\x01b")]


def with_text(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns, with the number of characters brought up to date."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def identify_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that have a language.  Those that op9 calls ``und`` (null or without letters) go, however short the others are."""
    samples = language.fit(docs)
    found = docs.withColumn("__found", language.identify(docs, F.col("text"), samples))
    return found.where(F.col("__found.lang") != language.UNKNOWN).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id."""
    return simhash.first_of_each(docs, simhash.near_copies(docs, shingle=4, limit=4))


def without_partial_characters(text: Column) -> Column:
    """The text without bytes that are no character.

    `make_valid_utf8` puts U+FFFD in their place, so those that the text contains are
    written as an escape meanwhile, and the escape's own first character as another.
    """
    for plain, escape in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(escape))
    text = F.replace(F.make_valid_utf8(text), F.lit("\ufffd"), F.lit(""))
    for plain, escape in reversed(ESCAPES):
        text = F.replace(text, F.lit(escape), F.lit(plain))
    return text


def drop_repeats(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without the passages of documents with smaller ids; a text of which nothing is left goes.

    Cuts are made between bytes; a character that a cut splits goes with the passage,
    a U+FFFD that the text contains stays.
    """
    cut = suffix_dedup.remove_repeats(docs, width=50)
    text = F.when(F.col("n_removed") > 0, without_partial_characters(F.col("kept").cast("string"))).otherwise(F.col("kept").cast("string"))
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_bytes")))
    return with_text(left.select("rest.*", text.alias("text")), docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    sizes = stored(mixing.sized(docs), "sized")
    mixed = mixing.mix(sizes, mixing.targets(sizes))
    return with_text(mixing.mixed_documents(docs, mixed), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), places=2048)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("mix_sources", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: fingerprints, suffix order and token ids have no SQL form; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; what each returns is stored and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
