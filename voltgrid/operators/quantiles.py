"""Exact quantiles by distributed selection.

Values are counted once per column.  Then rounds narrow the interval that holds a wanted
rank: edges that cut the interval's distinct values into about equal shares come from a
sketch of bounded size, the rows in each share are counted exactly, and the share that
holds the rank is the next interval.  A round cuts the distinct values by about `SHARES`,
whatever their distribution; when few are left they are looked up.  No task and no driver
holds more than the edges, the counts of the shares and the last few values.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: shares that a round cuts an interval into
SHARES = 256
#: distinct values that are looked up one by one
FEW = 1_024


@dataclass
class _Search:
    """Where a rank (from 0) of a column is looked for: values from ``low`` to ``high``, with ``before`` rows below them."""

    column: str
    rank: int
    low: float
    high: float
    before: int
    distinct: int
    value: float | None = None

    def inside(self) -> Column:
        return (F.col("column") == self.column) & (F.col("v") >= self.low) & (F.col("v") <= self.high)


def _narrow(counts: DataFrame, searches: list[_Search], shares: int) -> None:
    """One round: two jobs for all searches."""
    probabilities = [k / shares for k in range(1, shares)]
    edges = counts.agg(
        *(F.percentile_approx(F.when(s.inside(), F.col("v")), probabilities, 16 * shares).alias(f"e{i}") for i, s in enumerate(searches))
    ).first()
    parts = []
    for i, s in enumerate(searches):
        cuts = F.lit(sorted(set(edges[i])))
        share = F.size(F.filter(cuts, lambda e: e < F.col("v")))  # an edge closes its share
        parts.append(counts.where(s.inside()).groupBy(F.lit(i).alias("search"), share.alias("share")))
    found = reduce(
        DataFrame.unionByName,
        [p.agg(F.sum("n").alias("rows"), F.count("*").alias("distinct"), F.min("v").alias("low"), F.max("v").alias("high")) for p in parts],
    )
    by_search: dict[int, list] = {}
    for row in found.collect():  # at most `shares` rows per search
        by_search.setdefault(row["search"], []).append(row)
    for i, s in enumerate(searches):
        for row in sorted(by_search[i], key=lambda r: r["share"]):
            if s.rank < s.before + row["rows"]:
                s.low, s.high, s.distinct = row["low"], row["high"], row["distinct"]
                break
            s.before += row["rows"]


def _look_up(counts: DataFrame, searches: list[_Search]) -> None:
    wanted = reduce(lambda a, b: a | b, (s.inside() for s in searches))
    rows = sorted((r["column"], r["v"], r["n"]) for r in counts.where(wanted).collect())
    for s in searches:
        at = s.before
        for column, value, n in rows:
            if column == s.column and s.low <= value <= s.high:
                at += n
                if s.rank < at:
                    s.value = value
                    break


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], cut: int = SHARES, few: int = FEW) -> dict[str, list[float | None]]:
    """Per column the quantiles, linear between neighbours; null where a column has no values.

    Nulls and NaN do not count.  The work runs when called.
    """
    values = df.select(*(F.col(c).cast("double").alias(c) for c in columns)).unpivot([], list(columns), "column", "v")
    counts = materialise(values.where(F.col("v").isNotNull() & ~F.isnan("v")).groupBy("column", "v").agg(F.count(F.lit(1)).alias("n")))
    known = counts.groupBy("column").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct"), F.min("v").alias("low"), F.max("v").alias("high"))
    totals = {r["column"]: r for r in known.collect()}
    searches: dict[tuple[str, int], _Search] = {}
    for column, row in totals.items():
        for q in shares:
            place = (row["rows"] - 1) * q
            for rank in (math.floor(place), math.ceil(place)):
                searches.setdefault((column, rank), _Search(column, rank, row["low"], row["high"], 0, row["distinct"]))
    while wide := [s for s in searches.values() if s.distinct > few]:
        _narrow(counts, wide, cut)
    if searches:
        _look_up(counts, list(searches.values()))

    def between(column: str, q: float) -> float | None:
        if column not in totals:
            return None
        place = (totals[column]["rows"] - 1) * q
        first, last = math.floor(place), math.ceil(place)
        a, b = searches[column, first].value, searches[column, last].value
        return a if first == last or a == b else (last - place) * a + (place - first) * b

    return {c: [between(c, q) for q in shares] for c in columns}
