"""Near and nearest stops over an adaptive leaf index.

The plane is halved in x and y from the extent of the stops on; a cell is split
until it holds at most ``leaf_size`` distinct stop positions.  Nodes are keyed
by (level, cx, cy), the bits of a position above the level, and carry their
count and tight box; stops are keyed by their leaf.  A crowded place has
deeper leaves and nothing else: one search serves every density.

Both tables are written once to the shared checkpoint folder.  The node table
has at most levels x stops rows, the stop table one row a position.  The driver
sees the extent and the deepest level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citybeat.session import ensure_checkpoint_dir

#: Distinct stop positions a leaf may hold.
LEAF_SIZE = 16
#: Levels of a search between two cuts of its lineage.
CUT_LEVELS = 4
#: First levels of a search: at most 4 ** n cells for all positions, sent to every task instead of meeting by cell.
FEW_LEVELS = 7


@dataclass(frozen=True)
class LeafIndex:
    nodes: DataFrame  # level, cx, cy, leaf, x0, x1, y0, y1
    stops: DataFrame  # level, cx, cy of the leaf; sx, sy, sid
    origin: tuple[int, int]
    depth: int  # level of single positions
    first: int
    last: int


def build_index(
    stops: DataFrame, stop_id: str, x: str = "x", y: str = "y", leaf_size: int = LEAF_SIZE, least_extent: int | None = None
) -> LeafIndex | None:
    """The index of ``stops``; None when no stop has a position.

    Stops at one position count once, under the smallest id.  Levels start at the
    four quarters of the plane.  With ``least_extent`` they start at the smallest
    cells that are at least that wide, so that a window of that width meets four
    of them at most.
    """
    ensure_checkpoint_dir(stops.sparkSession)
    at = stops.groupBy(F.col(x).cast("long").alias("sx"), F.col(y).cast("long").alias("sy")).agg(F.min(stop_id).alias("sid"))
    at = at.filter(F.col("sx").isNotNull() & F.col("sy").isNotNull()).checkpoint()
    x0, y0, x1, y1 = at.agg(F.min("sx"), F.min("sy"), F.max("sx"), F.max("sy")).first()
    if x0 is None:
        return None
    depth = max(1, max(x1 - x0, y1 - y0).bit_length())
    first = 1 if least_extent is None else max(1, depth - max(0, int(least_extent) - 1).bit_length())

    def by_level(last: int) -> DataFrame:
        each = at.withColumn("level", F.explode(F.sequence(F.lit(first), F.lit(last))))
        cell = lambda c, o: F.expr(f"shiftright({c} - {o}L, {depth} - level)")
        return each.withColumns({"cx": cell("sx", x0), "cy": cell("sy", y0)})

    cells = by_level(depth).groupBy("level", "cx", "cy").agg(
        F.count(F.lit(1)).alias("n"), F.min("sx").alias("x0"), F.max("sx").alias("x1"), F.min("sy").alias("y0"), F.max("sy").alias("y1")
    )
    siblings = Window.partitionBy("level", F.shiftright("cx", 1), F.shiftright("cy", 1))
    in_parent = F.sum("n").over(siblings)
    nodes = (
        cells.withColumn("above", in_parent)
        .filter((F.col("level") == first) | (F.col("above") > leaf_size))
        .withColumn("leaf", (F.col("n") <= leaf_size) | (F.col("level") == depth))
        .select("level", "cx", "cy", "leaf", "x0", "x1", "y0", "y1")
        .checkpoint()
    )
    last = int(nodes.agg(F.max("level")).first()[0])
    leaves = nodes.filter("leaf").select("level", "cx", "cy")
    return LeafIndex(nodes, by_level(last).join(leaves, ["level", "cx", "cy"]).checkpoint(), (x0, y0), depth, first, last)


def _gap(p: Column, low: Column, high: Column) -> Column:
    return F.greatest(low - p, F.lit(0), p - high)


def _descend(start: DataFrame, index: LeafIndex, limit: int | None = None) -> DataFrame:
    """(px, py, d2, sid): the nearest stop of every position, ties to the smallest id.

    ``start`` holds (px, py, cx, cy): the cells of the first level to look into.
    All positions go down together.  A cell of the frontier is replaced by its
    non-empty children, a leaf by its stops; a cell stays only while its box
    may hold something nearer than the best stop or the farthest corner of any
    box of that position, and than the square root of ``limit``.  A row that
    asks for nothing is dealt by its position, under a key below all cells:
    one key for all of them would be one task.
    """
    sid_type = index.stops.schema["sid"].dataType
    # found: a row of the best stop so far; else a cell of the frontier
    state = start.select(
        "px", "py", F.lit(False).alias("found"), "cx", "cy", F.lit(None).cast("long").alias("d2"), F.lit(None).cast(sid_type).alias("sid")
    )
    names = state.columns
    # a fixed count: few rows become many on their way down, so that their first size says nothing; in this order
    # of columns the step is not taken for the one of a distinct before it
    n = int(start.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    state = state.repartition(n, "py", "px")
    px, py = F.col("px"), F.col("py")
    idle_x, idle_y = (F.bitwise_not(c.bitwiseAND(F.lit(0x7FFFFFFF))) for c in (px, py))
    for level in range(index.first, index.last + 1):
        kids = F.array(*[F.lit(q) for q in range(4)]) if level > index.first else F.array(F.lit(0))
        rows = state.withColumn("q", F.explode(F.when(F.col("found"), F.array(F.lit(0))).otherwise(kids)))
        if level > index.first:
            rows = rows.withColumns({"cx": F.col("cx") * 2 + F.col("q") % 2, "cy": F.col("cy") * 2 + F.shiftright("q", 1)})
        rows = rows.withColumns(
            {"cx": F.when(F.col("found"), idle_x).otherwise(F.col("cx")), "cy": F.when(F.col("found"), idle_y).otherwise(F.col("cy"))}
        )
        few = F.broadcast if level - index.first < FEW_LEVELS else lambda t: t
        here = few(index.nodes.filter(F.col("level") == level).drop("level"))
        rows = rows.join(here, ["cx", "cy"], "left").filter(F.col("found") | F.col("leaf").isNotNull())
        near_x, near_y = _gap(px, F.col("x0"), F.col("x1")), _gap(py, F.col("y0"), F.col("y1"))
        far_x = F.greatest(F.abs(px - F.col("x0")), F.abs(px - F.col("x1")))
        far_y = F.greatest(F.abs(py - F.col("y0")), F.abs(py - F.col("y1")))
        rows = rows.withColumns(
            {
                "low": near_x * near_x + near_y * near_y,
                "high": far_x * far_x + far_y * far_y,
                "lx": F.when(F.col("leaf"), F.col("cx")).otherwise(idle_x),
                "ly": F.when(F.col("leaf"), F.col("cy")).otherwise(idle_y),
            }
        )
        if limit is not None:
            rows = rows.filter(F.col("found") | (F.col("low") <= F.lit(limit)))
        opened = index.stops.filter(F.col("level") == level).select(
            F.col("cx").alias("lx"), F.col("cy").alias("ly"), "sx", "sy", F.col("sid").alias("leaf_sid")
        )
        rows = rows.join(few(opened), ["lx", "ly"], "left")
        exact = (px - F.col("sx")) * (px - F.col("sx")) + (py - F.col("sy")) * (py - F.col("sy"))
        is_leaf = F.coalesce("leaf", F.lit(False))
        rows = rows.select(
            "px", "py", (F.col("found") | is_leaf).alias("found"), "cx", "cy",
            F.when(is_leaf, exact).otherwise(F.col("d2")).alias("d2"),
            F.when(is_leaf, F.col("leaf_sid")).otherwise(F.col("sid")).alias("sid"),
            F.when(~is_leaf, F.col("low")).alias("low"), F.when(~is_leaf, F.col("high")).alias("high"),
        )
        of_point = Window.partitionBy("px", "py")
        rows = rows.withColumns(
            {
                "bound": F.min(F.coalesce("d2", "high")).over(of_point),
                "rank": F.row_number().over(of_point.orderBy(F.col("found").desc(), "d2", "sid")),
            }
        )
        keep = F.when(F.col("found"), F.col("rank") == 1).otherwise(F.col("low") <= F.col("bound"))
        # a found row joins no cell again
        cell = lambda c: F.when(~F.col("found"), F.col(c)).alias(c)
        state = rows.filter(keep).select("px", "py", "found", cell("cx"), cell("cy"), "d2", "sid").select(*names)
        if (level - index.first) % CUT_LEVELS == CUT_LEVELS - 1 and level < index.last:
            state = state.checkpoint().repartition(n, "py", "px")
    solved = state.filter("found")
    if limit is not None:
        solved = solved.filter(F.col("d2") <= F.lit(limit))
    return solved.select("px", "py", "d2", "sid")


def nearest(
    points: DataFrame, stops: DataFrame, point_id: str, stop_id: str, x: str = "x", y: str = "y", leaf_size: int = LEAF_SIZE
) -> DataFrame:
    """Exact nearest stop for every point with integer coordinates; ties go to the smallest stop id.

    Returns (point_id, stop_id, dist2).  Points sharing a position are solved
    once.  A table without stops gives every point a null stop; a point
    without a position has no row.
    """
    index = build_index(stops, stop_id, x, y, leaf_size)
    if index is None:
        none = F.lit(None).cast(stops.schema[stop_id].dataType).alias(stop_id)
        return points.select(F.col(point_id), none, F.lit(None).cast("long").alias("dist2"))
    located = points.select(F.col(point_id).alias("point"), F.col(x).cast("long").alias("px"), F.col(y).cast("long").alias("py"))
    located = located.filter(F.col("px").isNotNull() & F.col("py").isNotNull())
    side = F.explode(F.array(F.lit(0).cast("long"), F.lit(1).cast("long")))
    quarters = located.select("px", "py").distinct().withColumn("cx", side).withColumn("cy", side)
    solved = _descend(quarters, index)
    return located.join(solved, ["px", "py"]).select(
        F.col("point").alias(point_id), F.col("sid").alias(stop_id), F.col("d2").alias("dist2")
    )


def within_distance(
    points: DataFrame,
    stops: DataFrame,
    radius: int,
    x: str = "x",
    y: str = "y",
    center: tuple[int, int] | None = None,
    center_radius: int | None = None,
    leaf_size: int = LEAF_SIZE,
) -> DataFrame:
    """Points within ``radius`` of any stop, or within ``center_radius`` of ``center``.

    A point is near exactly when its nearest stop is.  The search starts at the
    up to four cells, at least as wide as the circle, that the circle around the
    point meets.  Rows keep their columns and repeats; a point without a
    position is near nothing.
    """
    dx, dy = F.col(x), F.col(y)
    at_center = F.lit(False)
    if center is not None:
        to_x, to_y = dx - center[0], dy - center[1]
        at_center = F.coalesce(to_x * to_x + to_y * to_y <= F.lit(center_radius * center_radius), F.lit(False))
    index = build_index(stops.withColumn("__one", F.lit(0)), "__one", x, y, leaf_size, 2 * radius + 1)
    if index is None:
        return points.filter(at_center)
    size_bits = index.depth - index.first
    most = (1 << index.first) - 1

    def cells(c: Column, origin: int) -> Column:
        low = F.greatest(F.shiftright(c - radius - origin, size_bits), F.lit(0).cast("long"))
        high = F.least(F.shiftright(c + radius - origin, size_bits), F.lit(most).cast("long"))
        return F.explode(F.when(low <= high, F.sequence(low, high)))

    asked = points.filter(~at_center).select(dx.cast("long").alias("px"), dy.cast("long").alias("py")).distinct()
    start = asked.withColumn("cx", cells(F.col("px"), index.origin[0])).withColumn("cy", cells(F.col("py"), index.origin[1]))
    near = _descend(start, index, radius * radius).select(F.col("px").alias("__px"), F.col("py").alias("__py"))
    same = (dx.cast("long") == F.col("__px")) & (dy.cast("long") == F.col("__py"))
    return points.filter(at_center).unionByName(points.filter(~at_center).join(near, same, "left_semi"))
