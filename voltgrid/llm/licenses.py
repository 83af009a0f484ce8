"""License scan with a positional index of licence words, in DataFrame operations only.

Licence texts are held as templates: a label, the words and one mandatory key phrase
inside them.  Every file's licence words are indexed with their positions.  The word of
a key phrase with the highest inverse document frequency is the template's rare word;
files that hold one are looked up, their postings are laid against the template's by
relative position (a posting at p of the template's word r votes for a start p - r),
and a start counts when all words of the key phrase stand there and, for the longer
templates, enough of the other words' weight.

Defined cases: a null or empty text has no words and no labels, score 0; overlapping
and repeated places all count; of equally rare words the first in the alphabet is the
rare word; repeated ids and rows are separate files; an empty table gives an empty
result; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: a word: no ASCII character but letters and digits; lower-cased afterwards
WORD = r"([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: share of a template's weight that must stand at a start
ENOUGH = 0.6


@dataclass(frozen=True)
class Template:
    """``key`` is a run of ``words``; ``base`` marks the phrases whose places are counted."""

    label: str
    words: str
    key: str
    base: bool = False

    def rows(self, number: int) -> list[tuple]:
        words, key = self.words.split(), self.key.split()
        start = next(i for i in range(len(words)) if words[i : i + len(key)] == key)
        return [
            (number, self.label, self.base, place, word, start <= place < start + len(key), len(key))
            for place, word in enumerate(words)
        ]


# The phrases that are counted, and sentences of well-known licences.
TEMPLATES = (
    Template("gpl", "gnu general public license", "gnu general public license", True),
    Template("apache", "apache license", "apache license", True),
    Template("cc-by", "cc by", "cc by", True),
    Template("mit", "mit license", "mit license", True),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    Template("apache", "licensed under the apache license version 2 0", "under the apache license"),
    Template("gpl", "you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute it and or modify it"),
    Template("lgpl", "gnu lesser general public license", "lesser general public license"),
    Template("agpl", "gnu affero general public license", "affero general public license"),
    Template("mpl", "subject to the terms of the mozilla public license", "mozilla public license"),
    Template("cc-by", "creative commons attribution", "creative commons attribution"),
    Template("cc0", "creative commons zero", "creative commons zero"),
    Template("proprietary", "all rights reserved", "all rights reserved"),
    Template("spdx", "spdx license identifier", "spdx license identifier"),
)


def template_rows(templates=TEMPLATES) -> list[tuple]:
    return [row for number, t in enumerate(templates) for row in t.rows(number)]


def index_words(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(file, doc_id, n_words, postings): the positions of the vocabulary's words, stored."""
    words = docs.select(F.col(id_col).alias("doc_id"), F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), 1).alias("words"))
    lower = lambda w: F.translate(w, UPPER, LOWER)
    postings = F.transform("words", lambda w, at: F.when(F.lower(w).isin(vocabulary), F.struct(lower(w).alias("word"), at.cast("long").alias("at"))))
    found = words.select(
        F.monotonically_increasing_id().alias("file"), "doc_id", F.size("words").cast("long").alias("n_words"), F.filter(postings, lambda p: p.isNotNull()).alias("postings")
    )
    return stored(found, "postings")


def scan(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) per file.

    The score is the largest share of weight (inverse document frequency) of an
    accepted template.  Templates are few and fixed, so their tables are broadcast.
    """
    spark = docs.sparkSession
    rows = template_rows(templates)
    vocabulary = sorted({r[4] for r in rows})
    files = index_words(docs, vocabulary, id_col, text_col)
    # document frequencies: one row per word of the vocabulary
    seen = files.select(F.explode(F.array_distinct(F.transform("postings", lambda p: p["word"]))).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    total, df = files.count(), {r["word"]: r["df"] for r in seen.collect()}
    rare = {}
    for number, _, _, _, word, in_key, _ in rows:
        if in_key and ((df.get(word, 0), word) < rare.get(number, (float("inf"), ""))):
            rare[number] = (df.get(word, 0), word)
    index = spark.createDataFrame(rows, "template int, label string, base boolean, place long, word string, in_key boolean, key_words long")
    frequency = spark.createDataFrame([(w, df.get(w, 0)) for w in vocabulary], "word string, df long")
    weighed = index.join(F.broadcast(frequency), "word").withColumn("weight", F.log((1.0 + total) / (1.0 + F.col("df"))) + 0.01)
    whole = weighed.groupBy("template").agg(F.sum(F.round("weight", 6)).alias("whole"))

    rare_words = sorted({w for _, w in rare.values()})
    looked_up = files.where(F.exists("postings", lambda p: p["word"].isin(rare_words))).select("file", F.explode("postings").alias("posting"))
    votes = looked_up.select("file", "posting.word", "posting.at").join(F.broadcast(weighed), "word")
    starts = (
        votes.groupBy("file", "template", (F.col("at") - F.col("place")).alias("start"))
        .agg(
            F.sum(F.round("weight", 6)).alias("weight"),
            F.count_if("in_key").alias("in_key"),
            F.first("key_words").alias("key_words"),
            F.first("label").alias("label"),
            F.first("base").alias("base"),
        )
        .where(F.col("in_key") == F.col("key_words"))
        .join(F.broadcast(whole), "template")
        .withColumn("share", F.round(F.least(F.col("weight") / F.col("whole"), F.lit(1.0)), 6))
        .where(F.col("share") >= ENOUGH)
    )
    base = F.col("base")
    joined = lambda c: F.array_join(F.array_sort(F.collect_set(c)), ",")  # noqa: E731  labels are few and fixed
    found = starts.groupBy("file").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("start"))).alias("first_word"),
        F.max(F.when(base, F.col("start"))).alias("last_word"),
        joined(F.when(base, F.col("label"))).alias("base_labels"),
        joined(F.col("label")).alias("labels"),
        F.max("share").alias("score"),
    )
    return files.select("file", "doc_id", "n_words").join(found, "file", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def check_sql(templates=TEMPLATES) -> str:
    """The same result as one SQL statement that lays every word against every template."""
    values = ", ".join(
        f"({n}, '{label}', {str(base).lower()}, {place}, '{word}', {str(key).lower()}, {many})" for n, label, base, place, word, key, many in template_rows(templates)
    )
    return rf"""
    WITH files AS (
        SELECT row_number() OVER () AS file, doc_id,
            regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), template(template, label, base, place, word, in_key, key_words) AS (VALUES {values}),
    posting AS (
        SELECT file, word, place - 1 AS stands FROM (SELECT file, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM files)
        WHERE word IN (SELECT word FROM template)
    ), frequency AS (SELECT word, count(DISTINCT file) AS df FROM posting GROUP BY word),
    weighed AS (
        SELECT t.*, round(ln((1.0 + (SELECT count(*) FROM files))::DOUBLE / (1.0 + coalesce(df, 0))::DOUBLE) + 0.01::DOUBLE, 6) AS weight
        FROM template t LEFT JOIN frequency USING (word)
    ), starts AS (
        SELECT file, template, stands - place AS start, any_value(label) AS label, any_value(base) AS base,
            round(least(sum(weight) / (SELECT sum(weight) FROM weighed w WHERE w.template = v.template), 1.0), 6) AS share
        FROM (SELECT p.file, p.stands, w.* FROM posting p JOIN weighed w USING (word)) v
        GROUP BY file, template, stands - place
        HAVING count(*) FILTER (WHERE in_key) = any_value(key_words)
    ), found AS (
        SELECT file, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
            string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
            max(share) AS score
        FROM starts WHERE share >= {ENOUGH} GROUP BY file
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
        coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
    FROM files LEFT JOIN found USING (file)
    """
