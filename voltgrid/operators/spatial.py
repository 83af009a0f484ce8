"""Spatial joins built from equi-joins on grid cells.

Nothing here compares all rows with all rows.  Points, line pieces and polygons
are put into square cells, candidates meet in an equi-join on the cell, and an
exact test decides.  Cells form a tree: one that holds too many items is split,
and only what lies in it goes on to smaller cells, so the level of a cell is part of
the join key and a crowded spot leaves the cells and pieces elsewhere as they are.
The nearest-neighbour search walks down the tree with bounding boxes and keeps only
boxes that can still hold the nearest item, so a crowded cell far from a point costs
one comparison.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import geodesy as G
from ..session import BROADCAST_BYTES, join_way, materialise

CELL_X, CELL_Y = "_cx", "_cy"
#: depth of a cell in a tree of cells
LEVEL = "_lv"
#: metres that rounding may move a position against its cell
_SLACK = 1e-3
#: items a cell may hold before it is split
CROWD = 256


def _width(df: DataFrame) -> int:
    """Partitions of a shuffle."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame) -> DataFrame:
    """Rows over as many tasks as a shuffle may have: geometry is much work on few bytes."""
    return df.repartition(_width(df))


def with_cell(df: DataFrame, x: str, y: str, size: float) -> DataFrame:
    """Add the cell a position (two SQL expressions) lies in."""
    return df.selectExpr("*", f"floor(({x}) / {size!r}D) AS {CELL_X}", f"floor(({y}) / {size!r}D) AS {CELL_Y}")


def cover_box(df: DataFrame, box: Sequence[str], size: float) -> DataFrame:
    """One row per cell that the box ``(x0, y0, x1, y1)`` touches."""
    x0, y0, x1, y1 = (f"floor(({c}) / {size!r}D)" for c in box)
    return df.selectExpr("*", f"explode(sequence({x0}, {x1})) AS {CELL_X}").selectExpr(
        "*", f"explode(sequence({y0}, {y1})) AS {CELL_Y}"
    )


# --------------------------------------------------------------------------
# pieces of lines
# --------------------------------------------------------------------------
SEGMENT = ("x1", "y1", "x2", "y2")
_BOX = ("bx0", "by0", "bx1", "by1")


def line_to_segments(lines: DataFrame, vertices: str, keep: Sequence[str]) -> DataFrame:
    """One row per segment with columns ``x1 y1 x2 y2``."""
    return lines.selectExpr(*keep, f"inline({G.line_segments(vertices)})")


def cut_segments(segments: DataFrame, piece: float) -> DataFrame:
    """Split segments into pieces no longer than ``piece``.

    Adds the box of each piece (``bx0 by0 bx1 by1``) and leaves the segment's
    own ends in place, so that distances are taken to the whole segment.
    """
    parts = f"cast(greatest(1, ceil({G.distance(*SEGMENT)} / {piece!r}D)) AS int)"
    cut = segments.selectExpr("*", f"{parts} AS _n").selectExpr("*", "explode(sequence(0, _n - 1)) AS _i")
    ax, ay = "x1 + (x2 - x1) * _i / _n", "y1 + (y2 - y1) * _i / _n"
    bx, by = "x1 + (x2 - x1) * (_i + 1) / _n", "y1 + (y2 - y1) * (_i + 1) / _n"
    return cut.selectExpr(
        *segments.columns,
        f"least({ax}, {bx}) AS bx0",
        f"least({ay}, {by}) AS by0",
        f"greatest({ax}, {bx}) AS bx1",
        f"greatest({ay}, {by}) AS by1",
    )


#: ends of a piece of a segment
_ENDS = ("ex1", "ey1", "ex2", "ey2")


def _with_ends(segments: DataFrame) -> DataFrame:
    """Each segment as a piece of its own."""
    return segments.selectExpr("*", *(f"{c} AS {e}" for c, e in zip(SEGMENT, _ENDS)))


def _cut_pieces(pieces: DataFrame, length: float) -> DataFrame:
    """Pieces no longer than ``length``, with their boxes; a piece is cut where it lies, not its whole segment."""
    rest = [c for c in pieces.columns if c not in (*_ENDS, *_BOX)]
    parts = f"cast(greatest(1, ceil({G.distance(*_ENDS)} / {length!r}D)) AS int)"
    cut = pieces.selectExpr(*rest, *_ENDS, f"{parts} AS _n").selectExpr("*", "explode(sequence(0, _n - 1)) AS _i")
    ends = ["ex1 + (ex2 - ex1) * _i / _n", "ey1 + (ey2 - ey1) * _i / _n", "ex1 + (ex2 - ex1) * (_i + 1) / _n", "ey1 + (ey2 - ey1) * (_i + 1) / _n"]
    return cut.selectExpr(*rest, *(f"{e} AS {c}" for e, c in zip(ends, _ENDS))).selectExpr(
        "*", "least(ex1, ex2) AS bx0", "least(ey1, ey2) AS by0", "greatest(ex1, ex2) AS bx1", "greatest(ey1, ey2) AS by1"
    )


def _crowded(placed: DataFrame, crowd: int) -> DataFrame:
    """Cells that hold more than ``crowd`` rows."""
    return placed.groupBy(CELL_X, CELL_Y).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > crowd).select(CELL_X, CELL_Y)


def line_cells(segments: DataFrame, grow: float, cell: float) -> DataFrame:
    """Segments in the cells their grown pieces touch, as a join side of checked size.

    A piece is at most one cell long, so its grown box touches at most
    ``reach`` squared cells; that bounds the size before anything is cut.
    """
    reach = 2 + math.ceil(2 * grow / cell)
    bound = f"greatest(1, ceil({G.distance(*SEGMENT)} / {cell!r}D)) * {reach * reach * 64}"
    g = f"{float(grow)!r}D"
    cells = cover_box(
        cut_segments(segments.select(*SEGMENT).distinct(), cell),
        [f"bx0 - {g}", f"by0 - {g}", f"bx1 + {g}", f"by1 + {g}"],
        cell,
    )
    return cells.select(CELL_X, CELL_Y, *SEGMENT).hint(join_way(segments, bound))


# --------------------------------------------------------------------------
# within a distance of lines
# --------------------------------------------------------------------------
def within_distance_of_lines(
    points: DataFrame,
    segments: DataFrame,
    radius: float,
    x: str = "x",
    y: str = "y",
    cell: float | None = None,
) -> DataFrame:
    """Points strictly nearer than ``radius`` to any segment (semi-join).

    Segments are cut to cell length and written to the cells their grown boxes
    touch; a point looks only into its own cell.  Without ``cell`` the points in small
    cells that a segment passes are settled first, and no line is copied for them.  For
    the others a cell that holds more than `CROWD` pieces is split, down to the radius,
    and only pieces in cells with such points are listed; the point then looks into
    the smallest cell it lies in.  Up to a radius of the first cells of `WALK` lines are
    walked to those points instead, and none is listed.
    """
    size = float(cell or max(radius * 16, 8_000.0))
    r = f"{float(radius)!r}D"
    near = f"{G.point_segment_distance(f'l.{x}', f'l.{y}', G.ends('r.'))} < {r}"
    if cell is not None:
        return _cell_join(with_cell(points, x, y, size), line_cells(segments, radius, size), near, "left_semi").select(*points.columns)
    lines = materialise(dealt(segments.select(*SEGMENT).distinct()))
    passed, open_, settled = _passed_cells(points, lines, radius, x, y), points, None
    if passed is not None:
        small = with_cell(points, x, y, _COVER * radius)
        settled = small.join(passed, [CELL_X, CELL_Y], "left_semi").select(*points.columns)
        open_ = materialise(small.join(passed, [CELL_X, CELL_Y], "left_anti").select(*points.columns))
        if radius <= WALK[0]:
            met = _within(_positions(open_, x, y), lines, radius).withColumnsRenamed({"_px": "_qx", "_py": "_qy"})
            return settled.unionByName(open_.join(met, F.expr(f"{x} = _qx AND {y} = _qy"), "left_semi"))
    tree, split = _line_tree(lines, radius, size, _positions(open_, x, y))
    placed = with_cell(open_, x, y, size).withColumn(LEVEL, F.lit(0))
    for level, cells in enumerate(split):
        # split cells are at most one in `CROWD` pieces; a point in one moves down to the smaller cell
        size /= SPLIT
        known = cells.selectExpr(f"{CELL_X} AS _ux", f"{CELL_Y} AS _uy", f"{level} AS _ul")
        met = placed.join(known, F.expr(f"{CELL_X} = _ux AND {CELL_Y} = _uy AND {LEVEL} = _ul"), "left")
        fine = [f"if(_ul IS NULL, {c}, floor(({v}) / {size!r}D)) AS {c}" for c, v in ((CELL_X, x), (CELL_Y, y))]
        placed = met.selectExpr(*points.columns, *fine, f"if(_ul IS NULL, {LEVEL}, {level + 1}) AS {LEVEL}")
    found = _cell_join(placed, tree, f"l.{LEVEL} = r.{LEVEL} AND {near}", "left_semi").select(*points.columns)
    return found if settled is None else settled.unionByName(found)


#: width of a cell, in radii, whose places are all nearer than the radius to a line through it (less than the root of 1/2)
_COVER = 0.7
#: pieces of that width a line may have on average; beyond, lines are too long to be walked
_WALK = 4_096

#: one line in so many is walked first
_FIRST = 16

_KEY = "_ck"


def _with_key(df: DataFrame) -> DataFrame:
    """Add the cell as one number; far cells may share one, so it only sorts out."""
    return df.withColumn(_KEY, F.expr(f"shiftleft({CELL_X}, 32) + {CELL_Y}"))


def _in_held(rows: DataFrame, held: DataFrame) -> DataFrame:
    """Rows in cells of ``held`` (or sharing their number); all rows when the cells are too many to send."""
    keys = _with_key(held).select(_KEY).distinct()
    if join_way(keys, "16") == "merge":
        return rows
    return _with_key(rows).join(F.broadcast(keys), _KEY, "left_semi").drop(_KEY)


def _passed_cells(points: DataFrame, lines: DataFrame, radius: float, x: str, y: str) -> DataFrame | None:
    """Small cells with a line through them, of those that hold points; nothing when a walk along the lines is too long.

    Lines are walked in the tasks that read them; what leaves a task is each cell once.
    """
    size = _COVER * radius
    steps = f"greatest(1, ceil({G.distance(*SEGMENT)} / {size!r}D))"
    if radius < 1.0 or lines.selectExpr(f"coalesce(avg({steps}), 0) > {_WALK} AS far").first()["far"]:
        return None
    at = [f"{a} + ({b} - {a}) * ((_i + 0.5D) / _n)" for a, b in (("x1", "x2"), ("y1", "y2"))]

    def met(some: DataFrame, held: DataFrame) -> DataFrame:
        walk = some.selectExpr(*SEGMENT, f"cast({steps} AS int) AS _n").selectExpr("*", "explode(sequence(0, _n - 1)) AS _i")
        return materialise(_in_held(with_cell(walk, *at, size).select(CELL_X, CELL_Y), held).distinct())

    # a few lines pass most cells where lines are dense; all lines are walked for the cells that are left
    held = with_cell(_positions(points, x, y), "_px", "_py", size).select(CELL_X, CELL_Y).distinct()
    first = met(lines.where(f"pmod(xxhash64({', '.join(SEGMENT)}), {_FIRST}) = 0"), held)
    left = materialise(held.join(first, [CELL_X, CELL_Y], "left_anti"))
    # cells that only share a number with a held one may be met in both walks
    return first.unionByName(met(lines, left)).distinct()


#: a crowded cell of lines is split into so many, each way
SPLIT = 4


def _line_tree(segments: DataFrame, radius: float, size: float, spots: DataFrame | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """Segments in cells of mixed levels, a side of checked size, and the split cells of each level.

    With ``spots`` (positions) only cells that hold one are listed.
    """
    g = f"({float(radius)!r}D + {_SLACK!r}D)"
    grown = [f"bx0 - {g}", f"by0 - {g}", f"bx1 + {g}", f"by1 + {g}"]

    def placed(pieces: DataFrame, level: int) -> DataFrame:
        cells = cover_box(_cut_pieces(pieces, size), grown, size)
        if spots is not None:
            cells = _in_held(cells, with_cell(spots, "_px", "_py", size))
        return cells.withColumn(LEVEL, F.lit(level))

    # pieces are cut anew for each level rather than stored: a level has several times the rows of the one above
    parts, split = [], []
    rows = placed(_with_ends(segments.select(*SEGMENT).distinct()), 0)
    while True:
        full = materialise(_crowded(rows, CROWD))
        if size / SPLIT < max(radius, 1.0) or full.isEmpty():
            break
        split.append(full)
        parts.append(rows.join(full, [CELL_X, CELL_Y], "left_anti"))
        inside = rows.join(full, [CELL_X, CELL_Y], "left_semi").withColumnsRenamed({CELL_X: "_ux", CELL_Y: "_uy"}).drop(LEVEL)
        size /= SPLIT
        # a piece touches neighbours too; those are split, or hold it, on their own
        finer = placed(inside, len(split)).where(f"floor({CELL_X} / {SPLIT}D) = _ux AND floor({CELL_Y} / {SPLIT}D) = _uy")
        rows = finer.drop("_ux", "_uy")
    parts.append(rows)
    whole = reduce(DataFrame.unionByName, [p.select(LEVEL, CELL_X, CELL_Y, *SEGMENT) for p in parts])
    return whole.hint(join_way(whole, "64")), split


def _cell_join(left: DataFrame, right: DataFrame, condition: str, how: str) -> DataFrame:
    """Rows of ``left`` with (semi) or without (anti) a partner in their cell.

    ``right`` is a side of checked size: when small it is broadcast and the
    rows stay where they are, hot cell or not.  Otherwise the rows are
    shuffled by cell and the planner's skew join splits the rows of a large
    cell over tasks, each with the cell's lines or polygons.  Only left rows
    come out; no pairs are listed.
    """
    same = f"l.{CELL_X} = r.{CELL_X} AND l.{CELL_Y} = r.{CELL_Y}"
    return left.alias("l").join(right.alias("r"), F.expr(f"{same} AND {condition}"), how)


def _positions(points: DataFrame, x: str, y: str) -> DataFrame:
    """Distinct positions; rows that share one are handled once."""
    return points.selectExpr(f"{x} AS _px", f"{y} AS _py").where("_px IS NOT NULL AND _py IS NOT NULL").distinct()


# --------------------------------------------------------------------------
# polygons
# --------------------------------------------------------------------------
#: cells of polygons begin at this share of their size, which coordinates with few digits never meet
_OFFSET = 0.3819660112501051


def _border(column: str, cell: float, step: int = 0) -> str:
    """Lower border of a polygon cell, or of one ``step`` cells on."""
    return f"(({column} + {step}) * {cell!r}D + {_OFFSET * cell!r}D)"


def polygon_cells(polygons: DataFrame, edges: str, grow: float, cell: float) -> DataFrame:
    """Cells where a polygon may be within ``grow``; a side of checked size.

    A cell has the edges that touch it (grown) and one bit, ``seed``: whether its lower right
    corner is inside.  A place in the cell is inside if the bit, the edges between it
    and the right border, and those that cross that border below it, are odd together
    (`within_cell`).  So each edge is copied only to the cells it passes, and a cell wholly
    inside has no edge at all.  Seeds come from the crossings of the cells' lower
    borders, in order: every second span between two is inside.
    """
    g, off = f"({float(grow)!r}D + {_SLACK!r}D)", f"{_OFFSET * cell!r}D"
    outlines = polygons.select(F.col(edges).alias("edges"))
    xs = "flatten(transform(edges, e -> array(e.x1, e.x2)))"
    ys = "flatten(transform(edges, e -> array(e.y1, e.y2)))"
    wide, high = (f"(2 + ceil((array_max({c}) - array_min({c})) / {cell!r}D))" for c in (xs, ys))
    reach = 2 + math.ceil(2 * grow / cell)
    around = f"aggregate(edges, 0D, (acc, e) -> acc + 2 + {G.distance(*G.ends('e.'))} / {cell!r}D)"
    way = join_way(outlines.where("size(edges) > 0"), f"48 * {wide} * {high} + 48 * {reach * reach} * {around}")

    # an outline is told by two hashes of it; equal outlines count once
    key = ["xxhash64(edges) AS _k1", "xxhash64(1, edges) AS _k2"]
    single = outlines.distinct().selectExpr(*key, "inline(edges)")
    line = _border(CELL_Y, cell)
    rows = [f"ceil((least(y1, y2) - {off}) / {cell!r}D)", f"floor((greatest(y1, y2) - {off}) / {cell!r}D)"]
    crossed = (
        single.selectExpr("*", f"{rows[0]} AS _r0", f"{rows[1]} AS _r1")
        .where("_r0 <= _r1")
        .selectExpr("*", f"explode(sequence(_r0, _r1)) AS {CELL_Y}")
        .where(f"(y1 > {line}) != (y2 > {line})")
        .groupBy("_k1", "_k2", CELL_Y)
        .agg(F.expr(f"sort_array(collect_list((x2 - x1) * ({line} - y1) / (y2 - y1) + x1)) AS _at"))
    )
    spans = "transform(sequence(0, size(_at) div 2 - 1), k -> struct(_at[2 * k] AS a, _at[2 * k + 1] AS b))"
    first, last = (f"ceil(({c} - {off}) / {cell!r}D) - {n}" for c, n in (("a", 1), ("b", 2)))
    seeds = (
        crossed.selectExpr("_k1", "_k2", CELL_Y, f"inline({spans})")
        .selectExpr("_k1", "_k2", CELL_Y, f"{first} AS _c0", f"{last} AS _c1")
        .where("_c0 <= _c1")
        .selectExpr("_k1", "_k2", f"explode(sequence(_c0, _c1)) AS {CELL_X}", CELL_Y, "true AS seed")
    )
    pieces = cut_segments(single, cell)
    box = [f"bx0 - {g} - {off}", f"by0 - {g} - {off}", f"bx1 + {g} - {off}", f"by1 + {g} - {off}"]
    passed = cover_box(pieces, box, cell).groupBy("_k1", "_k2", CELL_X, CELL_Y)
    touched = passed.agg(F.expr(f"collect_set(struct({', '.join(SEGMENT)})) AS edges"))
    whole = touched.join(seeds, ["_k1", "_k2", CELL_X, CELL_Y], "full")
    none = "cast(array() AS array<struct<x1:double,y1:double,x2:double,y2:double>>)"
    return whole.selectExpr(CELL_X, CELL_Y, f"coalesce(edges, {none}) AS edges", "coalesce(seed, false) AS seed").hint(way)


def within_cell(px: str, py: str, cell: float, radius: float) -> str:
    """Whether a place in a row of `polygon_cells` (as ``r``) is strictly inside the grown polygon."""
    right, low = _border(f"r.{CELL_X}", cell, 1), _border(f"r.{CELL_Y}", cell)
    beside = G.crossings_right(px, py, "r.edges", right)
    below = G.crossings_below(right, low, py, "r.edges")
    inside = f"(({beside} + {below} + cast(r.seed AS int)) % 2 = 1)"
    return f"({inside} OR {G.near_edges(px, py, 'r.edges', radius)})" if radius > 0 else inside


def points_by_polygons(
    points: DataFrame,
    polygons: DataFrame,
    edges: str = "edges",
    radius: float = 0.0,
    how: str = "left_semi",
    x: str = "x",
    y: str = "y",
    cell: float = 25_000.0,
) -> DataFrame:
    """Points within (semi) or outside (anti) the polygons grown by ``radius``."""
    inside = within_cell(f"l.{x}", f"l.{y}", cell, radius)
    off = f"{_OFFSET * cell!r}D"
    placed = with_cell(points, f"({x}) - {off}", f"({y}) - {off}", cell)
    return _cell_join(placed, polygon_cells(polygons, edges, radius, cell), inside, how).select(*points.columns)


def lines_clear_of_polygons(
    lines: DataFrame,
    line_id: str,
    vertices: str,
    polygons: DataFrame,
    edges: str = "edges",
    radius: float = 0.0,
    cell: float = 25_000.0,
) -> DataFrame:
    """Lines that share no point with any polygon grown by ``radius``.

    A line with one touching segment goes as a whole; it is not clipped.
    """
    outline = line_cells(polygons.selectExpr(f"inline({edges})"), radius, cell)
    segments = line_to_segments(dealt(lines.select(line_id, vertices)), vertices, [line_id])
    pieces = cover_box(cut_segments(segments, cell), ["bx0", "by0", "bx1", "by1"], cell).select(
        CELL_X, CELL_Y, line_id, *SEGMENT, *_BOX
    )
    # the piece that holds the touching spot has its box there too
    g = f"({float(radius)!r}D + {_SLACK!r}D)"
    boxes = " AND ".join(
        f"l.b{c}0 <= greatest(r.{c}1, r.{c}2) + {g} AND l.b{c}1 >= least(r.{c}1, r.{c}2) - {g}" for c in ("x", "y")
    )
    same = f"l.{CELL_X} = r.{CELL_X} AND l.{CELL_Y} = r.{CELL_Y}"
    met = pieces.alias("l").join(outline.alias("r"), F.expr(f"{same} AND {boxes}"))
    # four ends against the other segment, a row each: all in one condition is more code than the JVM compiles
    ends = [(p, q, o) for own, o in (("l.", "r."), ("r.", "l.")) for p, q in ((f"{own}x1", f"{own}y1"), (f"{own}x2", f"{own}y2"))]
    structs = (f"named_struct('_px', {p}, '_py', {q}, " + ", ".join(f"'{c}', {o}{c}" for c in SEGMENT) + ")" for p, q, o in ends)
    cross = G.segments_cross(G.ends("l."), G.ends("r."))
    four = met.selectExpr(f"l.{line_id}", f"{cross} AS _cross", f"inline(array({', '.join(structs)}))")
    hits = four.where(f"_cross OR {G.point_segment_distance('_px', '_py', G.ends())} <= {float(radius)!r}D")
    # a line that stays clear of every outline is inside or outside as a whole: its first vertex tells
    starts = lines.selectExpr(line_id, f"{vertices}[0].x AS x", f"{vertices}[0].y AS y")
    within = points_by_polygons(starts, polygons, edges, how="left_semi", cell=cell).select(line_id)
    touched = hits.select(line_id).unionByName(within).distinct()
    return lines.join(touched, line_id, "left_anti").select(*lines.columns)


# --------------------------------------------------------------------------
# nearest neighbour
# --------------------------------------------------------------------------
#: Cell sizes of the search pyramid, each a multiple of the next.  The number of
#: cells is bounded by the mapped area (1,300 x 1,100 km hold 90 cells of the
#: top and 340,000 of the lowest level), not by the number of items.
PYRAMID = (131_072.0, 16_384.0, 2_048.0)
#: a crowded cell of the lowest level is split into cells smaller by this factor, down to the smallest size
SHRINK, SMALLEST = 8.0, 0.5
_NODE_BYTES = 64


def nearest(
    points: DataFrame,
    items: DataFrame,
    payload: Sequence[str],
    tie_break: str,
    geometry: str = "point",
    x: str = "x",
    y: str = "y",
    distance_col: str = "distance_m",
    pyramid: Sequence[float] = PYRAMID,
    crowd: int = CROWD,
) -> DataFrame:
    """Left join with the nearest item: adds ``payload`` columns and the distance.

    ``items`` are points (columns ``x y``) or segments (``x1 y1 x2 y2``); of
    several items at the same distance the lowest ``tie_break`` wins.  Points
    without position, or without any item to find, get nulls.  Below ``pyramid`` cells
    are split until none holds more than ``crowd`` items, so the work for a position
    does not grow with the density of the items, nor that of the items elsewhere.  Among
    segments, positions with a line close by are settled without it.
    """
    # not by position: the planner would leave that to the step before, in as few parts as its bytes fill
    spots = dealt(_positions(points, x, y))
    met: list[DataFrame] = []
    if geometry == "segment":
        dist = G.point_segment_distance("_px", "_py", G.ends())
        shapes = materialise(_leaf_items(items, payload, tie_break, geometry))
        met, spots = _near_passing(materialise(spots), shapes, dist)
    else:
        dist, shapes = G.distance("_px", "_py", "x1", "y1"), _leaf_items(items, payload, tie_break, geometry)
    if not met or not spots.isEmpty():
        levels, leaves = _split_levels(_near_lines(spots, shapes, dist) if met else shapes, pyramid, crowd)
        leaves = leaves.hint(join_way(leaves, "200"))
        frontier = _descend(spots, leaves, levels, len(pyramid) - 1)
        # a crowded cell of a long item table is split at run time by the planner's skew join
        met.append(frontier.join(leaves, [LEVEL, CELL_X, CELL_Y]))
    found = (
        reduce(DataFrame.unionByName, [m.selectExpr("_px", "_py", f"named_struct('d', {dist}, 'item', _item) AS _found") for m in met])
        .groupBy("_px", "_py")
        .agg(F.min("_found").alias("_best"))
        .selectExpr(
            "_px", "_py", f"_best.d AS {distance_col}", *(f"_best.item.{c} AS {c}" for c in payload)
        )
    )
    same = F.expr(f"p.{x} = f._px AND p.{y} = f._py")
    return (
        points.alias("p")
        .join(found.alias("f"), same, "left")
        .select("p.*", *(f"f.{c}" for c in payload), f"f.{distance_col}")
    )


#: cells to a radius, each way, when places farther than a radius are told by cells
_FINE = 8


def farther_than(points: DataFrame, items: DataFrame, radius: float, x: str = "x", y: str = "y") -> DataFrame:
    """Points farther than ``radius`` from every item (columns ``x y``); those without position stay.

    Cells that hold items tell most places: one cell all of which is within the radius of
    a place's cell drops it, and a place with no such cell in reach stays.  Only the others
    look for their nearest item.
    """
    r = float(radius)
    size = max(r / _FINE, SMALLEST)
    reach = math.ceil(r / size) + 1
    held = with_cell(_positions(items, "x", "y"), "_px", "_py", size).select(CELL_X, CELL_Y).distinct()
    spread = held.selectExpr(CELL_X, CELL_Y, f"explode(sequence(-{reach}, {reach})) AS _i").selectExpr(
        "*", f"explode(sequence(-{reach}, {reach})) AS _j"
    )
    # farthest and nearest two places of the two cells
    far = f"hypot(abs(_i) + 1, abs(_j) + 1) * {size!r}D"
    near = f"hypot(greatest(abs(_i) - 1, 0), greatest(abs(_j) - 1, 0)) * {size!r}D"
    told = (
        spread.where(f"{near} <= {r + _SLACK!r}D")
        .groupBy((F.col(CELL_X) + F.col("_i")).alias(CELL_X), (F.col(CELL_Y) + F.col("_j")).alias(CELL_Y))
        .agg(F.expr(f"min({far}) <= {r - _SLACK!r}D AS _covered"))
    )
    told = materialise(told)
    placed = with_cell(points, x, y, size).join(told.hint(join_way(told, "32")), [CELL_X, CELL_Y], "left")
    placed = placed.select(*points.columns, F.expr(f"if({x} IS NULL OR {y} IS NULL, NULL, _covered)").alias("_covered"))
    open_ = materialise(placed.where("NOT _covered").drop("_covered"))
    alone = placed.where("_covered IS NULL").drop("_covered")
    if open_.isEmpty():
        return alone
    found = nearest(open_, items.selectExpr("x", "y", "1 AS _item_near"), ["_item_near"], "_item_near", x=x, y=y, distance_col="_item_m")
    return alone.unionByName(found.where(f"_item_m > {r!r}D").select(*points.columns))


#: cells of positions in the search along lines, each a power of two and `SPLIT` of the next
WALK = (2_048.0, 512.0, 128.0, 32.0, 8.0)
#: lines are cut to squares of this width before they are walked
TILE = 32_768.0
#: positions a cell may hold before it is split
FEW = 8
#: positions that are sent to the tasks at once
SENT = 1_000_000


def _near_passing(spots: DataFrame, lines: DataFrame, dist: str) -> tuple[list[DataFrame], DataFrame]:
    """Positions with the lines that can be their nearest, and the positions with no line through their cell.

    Positions lie in cells of mixed levels, at most `FEW` in one.  Lines are walked through the
    cells that hold positions: the nearest of those through a position's own cell bounds its
    search, and a second walk meets the cells around the position within that bound.  Pairs are
    met where the lines of a square are, and only the nearest leave the task; no pieces of lines
    are stored.
    """
    tiles = _tiles(spots, lines)
    open_, bounds, missed = materialise(_spot_cells(spots)), [], []
    while True:
        met = _meet(tiles, open_, lambda pairs: pairs.groupBy("_px", "_py", LEVEL).agg(F.expr(f"min({dist}) AS _bound")))
        bounds.append(met)
        alone = materialise(open_.join(met.select("_px", "_py"), ["_px", "_py"], "left_anti"))
        missed.append(alone.where(f"{LEVEL} = 0").select("_px", "_py"))
        # no line through the cell: the next larger one
        up = [f"floor({c} / {SPLIT}D) AS {c}" for c in (CELL_X, CELL_Y)]
        open_ = alone.where(f"{LEVEL} > 0").selectExpr("_px", "_py", *up, f"{LEVEL} - 1 AS {LEVEL}")
        if open_.isEmpty():
            break
    bounded = reduce(DataFrame.unionByName, bounds)
    near = _meet(tiles, _around(bounded), lambda pairs: pairs.where(f"{dist} <= _bound").select("_px", "_py", *SEGMENT))
    found = near.join(lines.select(*SEGMENT, "_item"), list(SEGMENT))
    return [found.select("_px", "_py", *SEGMENT, "_item")], reduce(DataFrame.unionByName, missed)


def _spot_cells(spots: DataFrame) -> DataFrame:
    """Positions in cells of mixed levels: one that holds more than `FEW` is split, down to the last level."""
    open_, parts = spots, []
    for level, size in enumerate(WALK):
        placed = with_cell(open_, "_px", "_py", size).withColumn(LEVEL, F.lit(level))
        full = materialise(_crowded(placed, FEW)) if size > WALK[-1] else None
        if full is None or full.isEmpty():
            break
        parts.append(placed.join(full, [CELL_X, CELL_Y], "left_anti"))
        open_ = placed.join(full, [CELL_X, CELL_Y], "left_semi").select("_px", "_py")
    columns = ["_px", "_py", CELL_X, CELL_Y, LEVEL]
    return reduce(DataFrame.unionByName, [p.select(*columns) for p in (*parts, placed)])


def _around(bounded: DataFrame) -> DataFrame:
    """Positions in all cells within their bound, which are half as wide as a cell where a level allows it."""
    fits = " ".join(f"WHEN _bound * 2 <= {size!r}D THEN {level}" for level, size in reversed([*enumerate(WALK)]))
    sizes = ", ".join(f"{size!r}D" for size in WALK)
    level = bounded.selectExpr("_px", "_py", "_bound", f"least({LEVEL}, CASE {fits} ELSE 0 END) AS {LEVEL}")
    sized = level.selectExpr("*", f"element_at(array({sizes}), {LEVEL} + 1) AS _s", f"_bound + {_SLACK!r}D AS _g")
    wide = sized.selectExpr("*", f"explode(sequence(floor((_px - _g) / _s), floor((_px + _g) / _s))) AS {CELL_X}")
    high = wide.selectExpr("*", f"explode(sequence(floor((_py - _g) / _s), floor((_py + _g) / _s))) AS {CELL_Y}")
    return materialise(high.drop("_s", "_g"))


def _tiles(spots: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines once for each square they pass that holds positions, those of a square in one task or a few."""
    passed = _along(_oriented(lines), TILE)
    # no bound is wider than a cell of the first level across
    g = f"{WALK[0] * 1.4143 + _SLACK!r}D"
    held = cover_box(spots, [f"_px - {g}", f"_py - {g}", f"_px + {g}", f"_py + {g}"], TILE).select(CELL_X, CELL_Y)
    cells = passed.selectExpr(*SEGMENT, "_cu", "_cv", f"if(_steep, _cv, _cu) AS {CELL_X}", f"if(_steep, _cu, _cv) AS {CELL_Y}")
    ranged = _in_held(cells, held).repartitionByRange(_width(lines), CELL_X, CELL_Y, *SEGMENT)
    return ranged.select(*SEGMENT, "_cu", "_cv")


def _within(spots: DataFrame, lines: DataFrame, radius: float) -> DataFrame:
    """Positions strictly nearer than ``radius`` to a line."""
    spots = materialise(dealt(spots))
    if spots.isEmpty():
        return spots
    dist = G.point_segment_distance("_px", "_py", G.ends())
    around = _around(spots.selectExpr("_px", "_py", f"{float(radius)!r}D AS _bound", f"{len(WALK) - 1} AS {LEVEL}"))
    return _meet(_tiles(spots, lines), around, lambda pairs: pairs.where(f"{dist} < _bound").select("_px", "_py").distinct())


def _oriented(lines: DataFrame) -> DataFrame:
    """Add the direction a segment is walked: from ``_u1`` to ``_u2`` along its longer side, with slope ``_m``."""
    steep = lines.selectExpr("*", "abs(y2 - y1) > abs(x2 - x1) AS _steep")
    turned = steep.selectExpr("*", "if(_steep, y1 > y2, x1 > x2) AS _back")
    ends = [f"if(_steep, if(_back, {c}2, {c}1), if(_back, {d}2, {d}1)) AS {name}" for c, d, name in (("y", "x", "_u1"), ("x", "y", "_v1"))]
    last = [f"if(_steep, if(_back, {c}1, {c}2), if(_back, {d}1, {d}2)) AS {name}" for c, d, name in (("y", "x", "_u2"), ("x", "y", "_v2"))]
    placed = turned.selectExpr("*", *ends, *last)
    return placed.selectExpr("*", "if(_u2 > _u1, (_v2 - _v1) / (_u2 - _u1), 0D) AS _m").drop("_back", "_v2")


def _along(rows: DataFrame, size: float, parent: float | None = None) -> DataFrame:
    """Oriented segments in each cell ``_cu _cv`` they pass, of those inside the cell of size ``parent`` they came in."""
    bounds = {"u": (f"floor(_u1 / {size!r}D)", f"floor(_u2 / {size!r}D)")}
    at = [f"_v1 + ({u} - _u1) * _m" for u in (f"greatest(_u1, _nu * {size!r}D)", f"least(_u2, (_nu + 1) * {size!r}D)")]
    bounds["v"] = (f"floor((least(_va, _vb) - {_SLACK!r}D) / {size!r}D)", f"floor((greatest(_va, _vb) + {_SLACK!r}D) / {size!r}D)")
    if parent is not None:
        k = int(parent / size)
        bounds = {c: (f"greatest({a}, _c{c} * {k})", f"least({b}, _c{c} * {k} + {k - 1})") for c, (a, b) in bounds.items()}
    kept = [c for c in rows.columns if c not in ("_cu", "_cv")]
    columns = rows.selectExpr("*", f"explode(sequence({bounds['u'][0]}, {bounds['u'][1]})) AS _nu")
    spans = columns.selectExpr("*", f"{at[0]} AS _va", f"{at[1]} AS _vb")
    spans = spans.selectExpr(*kept, "_nu AS _cu", f"{bounds['v'][0]} AS _lo", f"{bounds['v'][1]} AS _hi").where("_lo <= _hi")
    return spans.selectExpr(*kept, "_cu", "explode(sequence(_lo, _hi)) AS _cv")


def _meet(tiles: DataFrame, placed: DataFrame, keep: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Positions with each line through the cells they are placed in, reduced by ``keep`` and stored.

    Positions are sent to the lines, at most about `SENT` at once; a larger cell goes as a whole.
    """
    counts = {row[LEVEL]: row["n"] for row in placed.groupBy(LEVEL).agg(F.count(F.lit(1)).alias("n")).collect()} or {0: 0}
    turns = max(1, math.ceil(sum(counts.values()) / SENT))
    top = [f"shiftright({c}, 2 * {LEVEL})" for c in (CELL_X, CELL_Y)]
    met = []
    for turn in range(turns):
        now = placed if turns == 1 else placed.where(f"pmod(xxhash64({', '.join(top)}), {turns}) = {turn}")
        rows, parent, parts = _oriented(tiles), TILE, []
        for level, size in enumerate(WALK):
            cell = f"if(_steep, shiftleft(_cv, 32) + _cu, shiftleft(_cu, 32) + _cv) AS {_KEY}"
            rows = _along(rows, size, parent).selectExpr("*", cell)
            if level in counts:
                here = _with_key(now.where(F.col(LEVEL) == level)).drop(CELL_X, CELL_Y)
                parts.append(rows.join(F.broadcast(here), _KEY))
            if level >= max(counts):
                break
            inner = now.where(F.col(LEVEL) > level)
            up = [f"shiftright({c}, 2 * ({LEVEL} - {level})) AS {c}" for c in (CELL_X, CELL_Y)]
            keys = _with_key(inner.selectExpr(*up)).select(_KEY).distinct()
            rows, parent = rows.join(F.broadcast(keys), _KEY, "left_semi").drop(_KEY), size
        columns = ["_px", "_py", LEVEL, *(c for c in placed.columns if c == "_bound"), *SEGMENT]
        met.append(materialise(keep(reduce(DataFrame.unionByName, [p.select(*columns) for p in parts]))))
    return reduce(DataFrame.unionByName, met)


#: cells whose lines, and those of the cells around, bound the search of a place with none in its own, and the length of pieces for it
FAR, _PIECE = (4_096.0, 32_768.0), 8_192.0


def _near_lines(spots: DataFrame, lines: DataFrame, dist: str) -> DataFrame:
    """Pieces of lines that can be the nearest of the positions; all lines when a position has none around.

    One line of each cell around a position bounds its search.
    """
    oriented, near, open_ = _oriented(lines), [], spots
    for size in FAR:
        s = f"{size!r}D"
        around = cover_box(open_, [f"_px - {s}", f"_py - {s}", f"_px + {s}", f"_py + {s}"], size)
        passed = _along(oriented, size).selectExpr(*SEGMENT, f"if(_steep, _cv, _cu) AS {CELL_X}", f"if(_steep, _cu, _cv) AS {CELL_Y}")
        one = _in_held(passed, around).groupBy(CELL_X, CELL_Y).agg(F.expr(f"min(struct({', '.join(SEGMENT)})) AS _one"))
        pairs = around.join(one, [CELL_X, CELL_Y]).selectExpr("_px", "_py", "_one.*")
        bound = materialise(pairs.groupBy("_px", "_py").agg(F.expr(f"min({dist}) AS _bound")))
        g = f"(_bound + {_PIECE / 2 + _SLACK!r}D)"
        cells = cover_box(bound, [f"_px - {g}", f"_py - {g}", f"_px + {g}", f"_py + {g}"], size).select(CELL_X, CELL_Y)
        near.append((size, cells.distinct()))
        open_ = materialise(open_.join(bound, ["_px", "_py"], "left_anti"))
        if open_.isEmpty():
            break
    else:
        return lines
    pieces, middle = _cut_pieces(lines, _PIECE).drop(*_BOX), ("(ex1 + ex2) / 2", "(ey1 + ey2) / 2")
    parts = [_in_held(with_cell(pieces, *middle, size), cells).drop(CELL_X, CELL_Y) for size, cells in near]
    # a piece kept for two sizes comes twice; that changes no minimum
    return reduce(DataFrame.unionByName, parts)


def _crowded_levels(items, payload, tie_break, geometry, pyramid, crowd) -> tuple[list[float], DataFrame]:
    """`_split_levels` of items as they come."""
    return _split_levels(_leaf_items(items, payload, tie_break, geometry), pyramid, crowd)


def _split_levels(items: DataFrame, pyramid: Sequence[float], crowd: int) -> tuple[list[float], DataFrame]:
    """Cell sizes of the tree's levels, and its stored leaves: items in cells of mixed levels.

    A round looks only at what lies in the crowded cells of the round before.
    """
    levels, parts, open_ = list(pyramid), [], items
    while True:
        size = levels[-1]
        middle = ("(bx0 + bx1) / 2", "(by0 + by1) / 2")
        placed = materialise(with_cell(_cut_pieces(open_, size * 4), *middle, size).withColumn(LEVEL, F.lit(len(levels) - 1)))
        full = _crowded(placed, crowd)
        if size <= SMALLEST or full.isEmpty():
            break
        parts.append(placed.join(full, [CELL_X, CELL_Y], "left_anti"))
        open_ = placed.join(full, [CELL_X, CELL_Y], "left_semi").drop(CELL_X, CELL_Y, LEVEL)
        levels.append(size / SHRINK)
    return levels, reduce(DataFrame.unionByName, [p.drop(*_ENDS) for p in (*parts, placed)])


def _leaf_items(items: DataFrame, payload: Sequence[str], tie_break: str, geometry: str) -> DataFrame:
    """Items as pieces; equal geometries are merged into the winner of a tie."""
    fields = [tie_break, *(c for c in payload if c != tie_break)]
    item = "named_struct(" + ", ".join(f"'{c}', {c}" for c in fields) + ") AS _item"
    shape = ["x1", "y1"] if geometry == "point" else list(SEGMENT)
    given = ["x AS x1", "y AS y1"] if geometry == "point" else shape
    rows = items.selectExpr(*given, item).na.drop(subset=shape).groupBy(*shape).agg(F.min("_item").alias("_item"))
    if geometry == "point":
        return rows.selectExpr("*", "x1 AS ex1", "y1 AS ey1", "x1 AS ex2", "y1 AS ey2")
    return _with_ends(rows)


_CORNERS = ("x0", "y0", "x1", "y1")


def _hull() -> list:
    """The box around boxes."""
    return [F.expr(f"{f}({c}) AS {c}") for f, c in zip(("min", "min", "max", "max"), _CORNERS)]


def _descend(spots: DataFrame, leaves: DataFrame, levels: Sequence[float], base: int) -> DataFrame:
    """For each position the leaf cells that can hold its nearest item.

    Level ``base`` is the first that has leaves; its split cells, and theirs, have
    children on the levels below.
    """
    ends = (f"{b} AS {c}" for b, c in zip(_BOX, _CORNERS))
    ends_of_level = leaves.selectExpr(LEVEL, CELL_X, CELL_Y, *ends).groupBy(LEVEL, CELL_X, CELL_Y).agg(*_hull())
    stored = materialise(ends_of_level)
    way = "broadcast" if stored.count() * _NODE_BYTES <= BROADCAST_BYTES else "merge"
    kid = f"struct({CELL_X}, {CELL_Y}, {', '.join(_CORNERS)}, _leaf, {LEVEL})"
    frontier, inner, packed = spots, None, {}
    for level in range(len(levels) - 1, -1, -1):
        nodes = inner
        if level >= base:
            nodes = stored.where(F.col(LEVEL) == level).withColumn("_leaf", F.lit(True))
            nodes = nodes if inner is None else nodes.unionByName(inner)
        if level <= base:
            cells = nodes if level != base or inner is None else nodes.groupBy(CELL_X, CELL_Y).agg(*_hull())
            frontier = _own_bound(frontier, cells.hint(way), levels[level])
        if level == 0:
            break
        # the children of each parent cell in one array
        up = f"{levels[level - 1] / levels[level]!r}D"
        parents = nodes.groupBy(F.expr(f"floor({CELL_X} / {up}) AS _ux"), F.expr(f"floor({CELL_Y} / {up}) AS _uy")).agg(
            F.expr(f"collect_list({kid}) AS kids"), *_hull()
        )
        packed[level] = parents.selectExpr(f"_ux AS {CELL_X}", f"_uy AS {CELL_Y}", "kids")
        inner = parents.selectExpr(f"_ux AS {CELL_X}", f"_uy AS {CELL_Y}", *_CORNERS, "false AS _leaf", f"{level - 1} AS {LEVEL}")

    # the coarsest cells of the mapped area fit one array; it is read as a scalar, and a position is still one row
    top = nodes.agg(F.expr(f"collect_list({kid}) AS kids"))
    frontier = _children(frontier.withColumn("kids", top.scalar()).selectExpr("_px", "_py", "kids", f"least(_bound, {_FARTHEST}) AS _bound"))
    for level in range(1, len(levels)):
        below = packed[level].hint(way)
        if level <= base:
            frontier = _open(frontier, lambda cells: cells.join(below, [CELL_X, CELL_Y]))
            continue

        # leaves stay as they are; of a split cell the children come
        def with_kids(cells: DataFrame) -> DataFrame:
            met = cells.join(below.withColumn("_leaf", F.lit(False)), [CELL_X, CELL_Y, "_leaf"], "left")
            return met.withColumn("kids", F.expr(f"coalesce(kids, array({kid}))"))

        frontier = _open(frontier, with_kids)
    return frontier.select("_px", "_py", LEVEL, CELL_X, CELL_Y)


_NEAR = "hypot(greatest(x0 - _px, _px - x1, 0D), greatest(y0 - _py, _py - y1, 0D))"
_FAR = "hypot(greatest(_px - {0}x0, {0}x1 - _px), greatest(_py - {0}y0, {0}y1 - _py))"
#: the least of these over the boxes of an array
_FARTHEST = f"array_min(transform(kids, k -> {_FAR.format('k.')}))"


def _own_bound(spots: DataFrame, nodes: DataFrame, size: float) -> DataFrame:
    """Bound the distance by the box of the position's own cell, where that cell holds items."""
    bound = "_bound" if "_bound" in spots.columns else "cast(NULL AS double)"
    own = with_cell(spots, "_px", "_py", size).join(nodes, [CELL_X, CELL_Y], "left")
    return own.selectExpr("_px", "_py", f"least({bound}, {_FAR.format('')}) AS _bound")


def _open(frontier: DataFrame, with_kids: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Open the child boxes and keep those that may hold the nearest item.

    A box is certain to hold an item within its far corner, so the smallest far
    corner distance seen so far bounds the answer; boxes whose near side lies
    beyond it are dropped.  The bound of a position is found over its boxes, with the
    children looked up and let go, and the children come after it: what is sorted by
    position are the boxes, not all their children.
    """
    known = with_kids(frontier).selectExpr("_px", "_py", *_BOUNDED, f"least(_bound, {_FARTHEST}) AS _nearer")
    known = known.repartition(_width(known), "_px", "_py")
    shared = F.min("_nearer").over(Window.partitionBy("_px", "_py"))
    return _children(with_kids(known.withColumn("_bound", shared).drop("_nearer")))


_BOUNDED = (CELL_X, CELL_Y, *_CORNERS, "_leaf", LEVEL)


def _children(df: DataFrame) -> DataFrame:
    """The boxes in ``kids`` that begin within the bound."""
    return df.selectExpr("_px", "_py", "_bound", "inline(kids)").where(f"{_NEAR} <= _bound + {_SLACK}D")
