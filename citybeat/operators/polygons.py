"""Point in polygon (J4) with an index of clipped edges.

Polygons are rows (poly_id, ring); a polygon may have any number of rings, and
the union of all rings counts.  Every edge of a ring goes to the grid cells it
crosses.  Every cell has, per ring, the parity of its lower left corner, found
from the crossings of the ring with the cell row's lower line; only odd cells
are kept.  A point asks its own cell only: from the corner straight up to the
point's height, then right to the point, each edge of the cell crossed on the
way flips the parity.  Rings are never gathered: what is joined are single
edges and cells.

Coordinates are integers and all tests exact.  A point counts as a little
above and, far more, to the right of its place, so no path meets a vertex;
points on an edge are inside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citybeat.session import ensure_checkpoint_dir


def _cell(c: Column, size: int) -> Column:
    return F.floor(c / F.lit(size)).cast("long")


def ring_edges(polygons: DataFrame) -> DataFrame:
    """(ring, x1, y1, x2, y2): the edges of every row's closed ring, under a number of the row's own."""
    rings = polygons.select(F.monotonically_increasing_id().alias("ring"), F.col("ring").alias("p"))
    n = F.greatest(F.size("p") - 1, F.lit(0))
    pairs = F.zip_with(F.slice("p", F.lit(1), n), F.slice("p", F.lit(2), n), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    edges = rings.select("ring", F.explode(pairs).alias("e"))
    named = {"x1": "e.a.x", "y1": "e.a.y", "x2": "e.b.x", "y2": "e.b.y"}
    # written, so that the numbers stay when a task is run again
    return edges.select("ring", *[F.col(v).cast("long").alias(k) for k, v in named.items()]).checkpoint()


def edge_cells(edges: DataFrame, cell: int) -> DataFrame:
    """Every edge once for each cell it crosses or touches (a neighbouring row more at times)."""
    low, high = F.least("x1", "x2"), F.greatest("x1", "x2")
    by_column = edges.withColumn("cx", F.explode(F.sequence(_cell(low, cell), _cell(high, cell))))
    left, right = F.greatest(low, F.col("cx") * cell), F.least(high, (F.col("cx") + 1) * cell)

    def height(x: Column) -> Column:
        return F.col("y1") + (F.col("y2") - F.col("y1")) * F.try_divide(x - F.col("x1"), F.col("x2") - F.col("x1"))

    upright = F.col("x1") == F.col("x2")
    a = F.when(upright, F.col("y1").cast("double")).otherwise(height(left))
    b = F.when(upright, F.col("y2").cast("double")).otherwise(height(right))
    # one unit more on either side takes up the rounding of the heights
    rows = F.sequence(_cell(F.least(a, b) - 1, cell), _cell(F.greatest(a, b) + 1, cell))
    return by_column.withColumn("cy", F.explode(rows))


def odd_cells(edges: DataFrame, cell: int) -> DataFrame:
    """(ring, cx, cy): the cells whose lower left corner is inside the ring.

    A crossing of a row's lower line at x flips every corner left of it, so the
    odd corners lie between the first and second crossing from the right, the
    third and fourth, and so on.
    """
    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    # lower lines with low <= y < high
    lines = edges.filter("y1 <> y2").withColumn("cy", F.explode(F.sequence(F.ceil(low / cell), F.ceil(high / cell)))).filter(
        (F.col("cy") * cell >= low) & (F.col("cy") * cell < high)
    )
    # the last corner left of x = x1 + (x2 - x1) * (y - y1) / (y2 - y1): the largest k with k * cell < x
    rise = F.abs(F.col("y2") - F.col("y1"))
    over = (F.col("x2") - F.col("x1")) * (F.col("cy") * cell - F.col("y1")) * F.when(F.col("y2") > F.col("y1"), 1).otherwise(-1)
    # x * rise and k * cell * rise are integers, so the division is exact
    scaled = F.col("x1") * rise + over
    unit = rise * cell
    k = F.when(scaled > 0, F.expr("(scaled - 1) div unit")).otherwise(-1 - F.expr("(-scaled) div unit"))
    crossings = lines.withColumns({"scaled": scaled, "unit": unit}).select("ring", "cy", k.alias("k"))
    # crossings at the same corner cancel in pairs
    single = crossings.groupBy("ring", "cy", "k").agg(F.count(F.lit(1)).alias("n")).filter("n % 2 = 1")
    from_right = Window.partitionBy("ring", "cy").orderBy(F.col("k").desc())
    spans = single.withColumns({"place": F.row_number().over(from_right), "next": F.lead("k").over(from_right)})
    return spans.filter("place % 2 = 1").select("ring", F.explode(F.sequence(F.col("next") + 1, F.col("k"))).alias("cx"), "cy")


def _flips(x0: Column, y0: Column, px: Column, py: Column) -> Column:
    """Crossings of one edge with the way from the corner (x0, y0) up to the point's height and right to the point."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    dx, dy = x2 - x1, y2 - y1

    def below(y: Column) -> Column:
        """The edge passes x0 (a little to its right) under y (a little above it)."""
        way = F.when(dx > 0, 1).otherwise(-1)
        side = way * (dy * (x0 - x1) - (y - y1) * dx)
        return (side < 0) | ((side == 0) & (way * dy <= 0))

    up = ((x1 > x0) != (x2 > x0)) & below(py) & ~below(y0)

    def left_of(x: Column) -> Column:
        """x lies left of the edge at the point's height."""
        return F.when(dy > 0, (x - x1) * dy < dx * (py - y1)).otherwise((x - x1) * dy > dx * (py - y1))

    across = ((y1 > py) != (y2 > py)) & left_of(x0) & ~left_of(px)
    return up.cast("int") + across.cast("int")


def _on_edge(px: Column, py: Column) -> Column:
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    return (cross == 0) & px.between(F.least(x1, x2), F.greatest(x1, x2)) & py.between(F.least(y1, y2), F.greatest(y1, y2))


def points_in_polygons(points: DataFrame, polygons: DataFrame, x: str = "x", y: str = "y", cell: int = 100) -> DataFrame:
    """Rows of ``points`` inside (or on the boundary of) any ring of ``polygons`` (poly_id, ring).

    ``ring``: closed arrays of struct<x, y>.  Positions are asked once each,
    then the rows at inside positions are kept, so no row is repeated.
    """
    ensure_checkpoint_dir(points.sparkSession)
    edges = ring_edges(polygons)
    places = points.select(F.col(x).cast("long").alias("px"), F.col(y).cast("long").alias("py")).distinct()
    keyed = places.withColumns({"cx": _cell(F.col("px"), cell), "cy": _cell(F.col("py"), cell)})
    corner = (F.col("cx") * cell, F.col("cy") * cell, F.col("px"), F.col("py"))
    crossed = keyed.join(edge_cells(edges, cell), ["cx", "cy"]).select(
        "px", "py", "ring", _flips(*corner).alias("flips"), _on_edge(F.col("px"), F.col("py")).alias("touches")
    )
    corners = keyed.join(odd_cells(edges, cell), ["cx", "cy"]).select("px", "py", "ring", F.lit(1).alias("flips"), F.lit(False).alias("touches"))
    inside = (
        crossed.filter("flips > 0 OR touches")
        .unionByName(corners)
        .groupBy("px", "py", "ring")
        .agg(F.sum("flips").alias("flips"), F.max("touches").alias("touches"))
        .filter("flips % 2 = 1 OR touches")
        .select("px", "py")
    )
    here = (F.col(x).cast("long") == F.col("px")) & (F.col(y).cast("long") == F.col("py"))
    return points.join(inside, here, "left_semi")
