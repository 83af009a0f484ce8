"""Connected components of links, in rounds of joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first())


def _neighbours(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
        edges.select(F.col("low").alias("node"), F.col("high").alias("other"))
    )


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the smallest node reachable.

    Alternates two star steps until nothing changes.  The large step links every
    larger neighbour of a node to the smallest neighbour; the small step does so with
    the smaller ones and the node itself.  Both keep components whole, and the links
    end as stars around the roots after a number of rounds that grows with the
    logarithm of the longest chain.  A node with very many links is a minimum that is
    combined before the shuffle, and a key that a skewed join can split.

    Links may repeat and may name a node twice; null ends are ignored; no links give an
    empty result.
    """
    ends = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
    edges = stored(ends.distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = _neighbours(edges)
        least = both.groupBy("node").agg(F.min("other").alias("least"))
        large = (
            both.join(least, "node")
            .where(F.col("other") > F.col("node"))
            .select(F.col("other").alias("high"), F.least("node", "least").alias("low"))
            .distinct()
        )
        large = stored(large, "large")
        low = large.groupBy("high").agg(F.min("low").alias("least"))
        small = large.join(low, "high").select(
            F.when(F.col("low") == F.col("least"), F.col("high")).otherwise(F.col("low")).alias("high"), F.col("least").alias("low")
        )
        edges = stored(small.distinct(), "small")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.groupBy("low").agg(F.lit(1)).select(F.col("low").alias("node"), F.col("low").alias("root"))
    return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(roots)
