"""Outlines of covered grid cells (G6): boundary tracing as joins and aggregates.

Every cell has four directed unit edges, counter-clockwise.  Two neighbouring
cells run along their common edge in opposite ways, so the two cancel in one
sum per edge; what is left is the boundary, interior on the left.  An edge goes
on with the edge that starts where it ends; where two cells touch in a corner
only, it turns left, so rings never cross themselves and cells that share no
side have rings of their own.  Rings are numbered by pointer jumping: every
round each edge looks twice as far back for the smallest edge of its ring, and
finds its place in the ring with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citybeat.session import ensure_checkpoint_dir

# Directions of an edge: 0 east, 1 north, 2 west, 3 south.
_OFFSET = 1 << 30


def _edge_id(x: Column, y: Column, upright: Column) -> Column:
    """A number for the unit edge with lower left end (x, y), ordered by x, y, lying before upright; |x|, |y| < 2**30."""
    return F.shiftleft(F.shiftleft(x + _OFFSET, 31) + (y + _OFFSET), 1) + upright


def boundary_edges(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, id, x, y, dir): the directed unit edges between the covered and the other cells; (x, y) is an edge's start."""
    cx, cy = F.col("cx").cast("long"), F.col("cy").cast("long")

    def side(x: Column, y: Column, upright: int, way: int) -> Column:
        return F.struct(x.alias("x"), y.alias("y"), F.lit(upright).alias("upright"), F.lit(way).alias("way"))

    sides = F.array(side(cx, cy, 0, 1), side(cx + 1, cy, 1, 1), side(cx, cy + 1, 0, -1), side(cx, cy, 1, -1))
    left = cells.select(*keys, F.inline(sides)).groupBy(*keys, "x", "y", "upright").agg(F.sum("way").alias("way")).filter("way != 0")
    back = F.col("way") < 0
    return left.select(
        *keys,
        _edge_id(F.col("x"), F.col("y"), F.col("upright")).alias("id"),
        F.when(back & (F.col("upright") == 0), F.col("x") + 1).otherwise(F.col("x")).alias("x"),
        F.when(back & (F.col("upright") == 1), F.col("y") + 1).otherwise(F.col("y")).alias("y"),
        (F.col("upright") + F.when(back, 2).otherwise(0)).alias("dir"),
    )


def _end(x: str, y: str, d: str) -> tuple[Column, Column]:
    along = F.when(F.col(d) < 2, 1).otherwise(-1)
    upright = F.col(d) % 2 == 1
    return F.when(upright, F.col(x)).otherwise(F.col(x) + along), F.when(upright, F.col(y) + along).otherwise(F.col(y))


def linked_edges(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, id, x, y, dir, back, corner): every edge with the edge before it; ``corner`` where the direction changes."""
    ex, ey = _end("x", "y", "dir")
    ends = edges.select(*keys, F.col("id").alias("back"), ex.alias("x"), ey.alias("y"), F.col("dir").alias("from_dir"))
    turn = (F.col("dir") - F.col("from_dir") + 4) % 4
    # left, straight on, right
    rank = F.when(turn == 1, 0).when(turn == 0, 1).otherwise(2)
    pick = F.min(F.struct(rank.alias("rank"), "id", "x", "y", "dir")).alias("p")
    return ends.join(edges, [*keys, "x", "y"]).groupBy(*keys, "back").agg(pick).select(
        *keys, "p.id", "p.x", "p.y", "p.dir", "back", (F.col("p.rank") != 1).alias("corner")
    )


def ring_places(links: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, id, ring, place): the smallest edge of every edge's ring and the number of edges from it on.

    A round that changes nothing looked at least once around every ring.
    """
    state = links.select(*keys, "id", "back", F.col("id").alias("ring"), F.lit(0).cast("long").alias("place")).checkpoint()
    step = 1
    while True:
        behind = state.select(
            *keys, F.col("id").alias("back"), F.col("back").alias("further"), F.col("ring").alias("r"), (F.col("place") + step).alias("p")
        )
        nearer = F.struct(F.col("r").alias("ring"), F.col("p").alias("place"))
        best = F.least(F.struct("ring", "place"), nearer)
        state = state.join(behind, [*keys, "back"]).select(
            *keys, "id", F.col("further").alias("back"), best.alias("b"), (F.col("r") < F.col("ring")).alias("moved")
        ).select(*keys, "id", "back", "b.ring", "b.place", "moved").checkpoint()
        if state.filter("moved").isEmpty():
            return state.select(*keys, "id", "ring", "place")
        state = state.drop("moved")
        step *= 2


def outlines(cells: DataFrame, keys: Sequence[str], cell: int) -> DataFrame:
    """One row per ring of the covered ``cells`` (keys, cx, cy; no repeats) of every key.

    Columns: keys, ring (its smallest edge), hole, edges, area_m2 (negative for
    holes, so the areas of a key add up to its cells), outline (corners from the
    smallest edge on, counter-clockwise for outer rings, closed, as JSON).
    """
    ensure_checkpoint_dir(cells.sparkSession)
    links = linked_edges(boundary_edges(cells, keys).checkpoint(), keys).checkpoint()
    placed = links.join(ring_places(links, keys), [*keys, "id"])
    ex, ey = _end("x", "y", "dir")
    # twice the area that an edge spans with the origin
    twice = F.sum(F.col("x") * ey - ex * F.col("y"))
    point = F.format_string("[%d, %d]", F.col("x") * cell, F.col("y") * cell)
    corners = F.array_sort(F.collect_list(F.when(F.col("corner"), F.struct("place", point.alias("at")))))
    rings = placed.groupBy(*keys, "ring").agg(
        F.count(F.lit(1)).alias("edges"), (twice * cell * cell / 2).cast("long").alias("area_m2"), corners.alias("c")
    )
    at = F.transform("c", lambda p: p["at"])
    return rings.select(
        *keys, "ring", (F.col("area_m2") < 0).alias("hole"), "edges", "area_m2",
        F.concat(F.lit("["), F.array_join(F.concat(at, F.slice(at, 1, 1)), ", "), F.lit("]")).alias("outline"),
    )
