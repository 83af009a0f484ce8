"""Mixing sources to target weights (Efraimidis-Spirakis sampling), in DataFrame operations only.

Every document gets an exponential key scaled by its quality weight.  Within its
source, documents are taken in the order of their keys until the running sum of
sizes reaches the source's token budget.  A budget above the source's size first
takes whole epochs (every document once more), then the fractional selection; the
document on the boundary gives as many words as are left, so a source's taken words
equal its target to the word.

Defined cases: a null or empty text has size 0 and is taken 0 times; null is a source
of its own and comes last; of equal keys the smaller id, then the smaller size, comes
first; repeated rows are separate documents; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import buckets_for, running_total

WORDS = r"[^\x20\x09-\x0D]+"
#: smallest quality weight; the largest is 1
LEAST_QUALITY = 0.25


def letter_share(text: Column) -> Column:
    """Quality weight of a text: its share of letters, at least `LEAST_QUALITY`."""
    letters = F.length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    share = letters / F.greatest(F.length(text), F.lit(1))
    return F.greatest(F.coalesce(share, F.lit(0.0)), F.lit(LEAST_QUALITY))


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, size, quality, text_hash) of every document."""
    text = F.col(text_col)
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        letter_share(text).alias("quality"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"),
    )


def targets(documents: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, rank, n_docs, source_size, target) per source.

    Sources in code point order, null last, weigh ``weights``, repeating.  They share
    ``share`` times all sizes by weight; no target exceeds ``most`` times its source's
    size, and the excess goes to the others by weight.  With limits sorted by limit per
    weight, all sources before some place are at their limit and all others get the
    same amount per unit of weight; one pass over the sources finds that place.
    """
    whole = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("per_weight", "rank")
    ahead = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_limit.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    sources = (
        documents.groupBy("source")
        .agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(by_name))
    )
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int"))
    return (
        sources.withColumn("weight", weight)
        .withColumn("limit", F.col("source_size") * most)
        .withColumn("per_weight", F.col("limit") / F.col("weight"))
        .withColumn("budget", F.sum("source_size").over(whole) * share)
        .withColumn(
            "level",
            (F.col("budget") - F.coalesce(F.sum("limit").over(ahead), F.lit(0.0))) / F.sum("weight").over(onward),
        )
        .withColumn("open", F.when(F.col("level") <= F.col("per_weight"), F.col("level")))
        .withColumn("level", F.first("open", ignorenulls=True).over(by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .withColumn("target", F.coalesce(F.least("limit", F.col("level") * F.col("weight")), F.col("limit")))
        .select("source", "rank", "n_docs", "source_size", "target")
    )


def uniform(key: Column, seed: int) -> Column:
    """A number in (0, 1) that depends on the key alone: 52 bits of its digest."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def mix(documents: DataFrame, budgets: DataFrame, seed: int = 17) -> DataFrame:
    """(doc_id, size, source_size, target, taken, source, text_hash) per row of ``documents`` (as `sized` gives them).

    Keys are spread over buckets by 1 - exp(-key * least quality), which no quality
    weight can pile up more than 1 / `LEAST_QUALITY` fold, so a source of any size is
    sorted and summed in pieces of about the root of its rows.
    """
    size, rest = F.col("size"), F.col("rest")
    plan = (
        budgets.withColumnRenamed("source", "of_source")
        .withColumn("epochs", F.floor(F.col("target") / F.greatest("source_size", F.lit(1))))
        .withColumn("rest", F.floor(F.col("target") + 0.5).cast("long") - F.col("epochs") * F.col("source_size"))
        .withColumn("buckets", buckets_for(F.col("n_docs")))
    )
    keyed = (
        documents.join(plan, F.col("source").eqNullSafe(F.col("of_source")))
        .withColumn("key", -F.log(uniform(F.col("doc_id"), seed)) / F.col("quality"))
        .withColumn("spread", 1 - F.exp(-F.col("key") * LEAST_QUALITY))
        .withColumn("bucket", F.least(F.floor(F.col("spread") * F.col("buckets")), F.col("buckets") - 1))
        .select("doc_id", "size", "source_size", "target", "epochs", "rest", "rank", "bucket", "key", "source", "text_hash")
    )
    summed = running_total(keyed, "rank", "bucket", ["key", "doc_id", "size"], "size", "ahead")
    part = F.greatest(F.lit(0), F.least(size, rest - F.col("ahead")))
    taken = (F.col("epochs") * size + part).cast("long").alias("taken")
    return summed.select("doc_id", "size", "source_size", "target", taken, "source", "text_hash")


def mixed_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mix as documents: each as often as it is taken, the last time perhaps with its first words only.

    Rows that agree in id, text and source are one row here, taken as often as all of
    them.  A shortened text is its words, joined by a space.
    """
    key = F.struct(F.col("doc_id").alias("id"), F.col("source").alias("source"), F.col("text_hash").alias("hash"))
    shares = mixed.groupBy(key.alias("__key")).agg(F.max("size").alias("__size"), F.sum("taken").alias("__taken")).where(F.col("__taken") > 0)
    text = F.col(text_col)
    own = F.struct(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("hash"))
    rows = docs.withColumn("__key", own).dropDuplicates(["__key"]).join(shares, "__key")
    left = (F.col("__taken") % F.col("__size")).cast("int")
    whole = F.array_repeat(text, F.floor(F.col("__taken") / F.col("__size")).cast("int"))
    cut = F.when(left > 0, F.array(F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"({WORDS})"), 1), 1, F.greatest(left, F.lit(1))), " ")))
    return rows.withColumn(text_col, F.explode(F.concat(whole, F.coalesce(cut, F.array().cast("array<string>"))))).select(*docs.columns)
