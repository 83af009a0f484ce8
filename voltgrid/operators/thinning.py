"""Greedy spatial thinning in parallel rounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geodesy as G
from ..session import materialise
from .spatial import CELL_X, CELL_Y, with_cell

_REACH = 2  # a cell is radius / sqrt(2) wide, so conflicts reach two cells at most


def greedy_thinning(
    points: DataFrame,
    radius: float,
    order: Sequence[str],
    descending: Sequence[str] = (),
    x: str = "x",
    y: str = "y",
) -> DataFrame:
    """Keep a point when it is farther than ``radius`` from every better kept point.

    The result is that of walking the points one by one in the given order
    (``descending`` columns largest first).  No pairs are listed: two points
    of one cell always conflict, so only the best open point of each cell can
    be kept in a round.  It is kept when it beats the best open points of the
    24 cells around it; then all open points within ``radius`` of kept ones
    are dropped.  The overall best open point is always kept, so the rounds
    end, and both the winners and the losers are those of the walk.
    """
    cell = float(radius) / 2**0.5
    rank = F.struct(
        *((-F.col(c)).alias(f"k{i}") if c in descending else F.col(c).alias(f"k{i}") for i, c in enumerate(order))
    )
    row = F.struct(rank.alias("rank"), F.struct(*points.columns).alias("row"))
    # of points at one spot only the best can survive
    open_points = materialise(
        points.groupBy(F.col(x).alias("_x"), F.col(y).alias("_y"))
        .agg(F.min(row).alias("p"))
        .transform(with_cell, "_x", "_y", cell)
    )
    kept_rounds: list[DataFrame] = []
    while not open_points.isEmpty():
        kept = materialise(_round_winners(open_points))
        kept_rounds.append(kept)
        open_points = materialise(_drop_near(open_points, kept, radius))
    if not kept_rounds:
        return points.limit(0)
    result = kept_rounds[0]
    for kept in kept_rounds[1:]:
        result = result.unionByName(kept)
    return result.select("p.row.*")


def _spread_cells(df: DataFrame) -> DataFrame:
    """Repeat each row for the cells around its own (and its own)."""
    other = [c for c in df.columns if c not in (CELL_X, CELL_Y)]

    def around(c: str) -> str:
        return f"explode(sequence({c} - {_REACH}, {c} + {_REACH})) AS {c}"

    return df.selectExpr(*other, CELL_Y, around(CELL_X)).selectExpr(*other, CELL_X, around(CELL_Y))


def _round_winners(open_points: DataFrame) -> DataFrame:
    """Cell leaders that beat all leaders around them."""
    leaders = open_points.groupBy(CELL_X, CELL_Y).agg(F.min(F.struct("p", "_x", "_y")).alias("lead"))
    around = (
        _spread_cells(leaders.select(CELL_X, CELL_Y, F.col("lead.p.rank").alias("rank")))
        .groupBy(CELL_X, CELL_Y)
        .agg(F.min("rank").alias("best"))
    )
    return (
        leaders.join(around, [CELL_X, CELL_Y])
        .where(F.col("lead.p.rank") == F.col("best"))
        .select(CELL_X, CELL_Y, "lead.p", "lead._x", "lead._y")
    )


def _drop_near(open_points: DataFrame, kept: DataFrame, radius: float) -> DataFrame:
    """Open points farther than ``radius`` from the points kept in this round.

    The kept side has at most one point per cell of the mapped area; the
    runtime planner sees its stored size and sends it to the open points.
    """
    near = _spread_cells(kept.select(CELL_X, CELL_Y, F.col("_x").alias("_kx"), F.col("_y").alias("_ky")))
    o, k = open_points.alias("o"), near.alias("k")
    hit = f"{G.distance('o._x', 'o._y', 'k._kx', 'k._ky')} <= {float(radius)!r}D"
    same = f"o.{CELL_X} = k.{CELL_X} AND o.{CELL_Y} = k.{CELL_Y}"
    return o.join(k, F.expr(f"{same} AND {hit}"), "left_anti")
