"""Road-network jobs (G2-G7): travel times, induced subgraphs, reachable
bands, coverage and routes.  The searches themselves are in ``paths``.

The graph is two DataFrames: nodes (node_id, x, y) and directed edges
(u, v, key, length).  Shortest paths are computed for all sources (and
optional keys such as the travel mode) at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citybeat.operators import task_search
from citybeat.operators.leaf_index import nearest, within_distance
from citybeat.operators.paths import Goals, bounded_costs, landmark_bounds, shortest_paths
from citybeat.session import ensure_checkpoint_dir


def travel_times(edges: DataFrame, modes: dict[str, float]) -> DataFrame:
    """Edge travel time in seconds for every mode: length / (km/h -> m/s), 0 at speed 0."""
    arr = F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(float(s)).alias("speed_kmh")) for m, s in modes.items()])
    out = edges.withColumn("__m", F.explode(arr))
    speed_ms = F.col("__m.speed_kmh") * 1000.0 / 3600.0
    return out.select(
        *edges.columns,
        F.col("__m.mode").alias("mode"),
        F.when(speed_ms > 0, F.col("length") / speed_ms).otherwise(F.lit(0.0)).alias("travel_time"),
    )


def induced_subgraph(edges: DataFrame, allowed: DataFrame, node_col: str = "node_id") -> DataFrame:
    """Edges whose both ends are allowed nodes: two semi joins."""
    ok = allowed.select(F.col(node_col).alias("__n")).distinct()
    keep_u = edges.join(ok, edges["u"] == ok["__n"], "left_semi")
    return keep_u.join(ok, keep_u["v"] == ok["__n"], "left_semi")


def allowed_nodes(nodes: DataFrame, stops: DataFrame, stop_radius: int, center: tuple[int, int], center_radius: int) -> DataFrame:
    """Nodes within ``stop_radius`` of a stop or ``center_radius`` of the centre (G4 input, J5)."""
    return within_distance(nodes, stops, stop_radius, "x", "y", center, center_radius)


def reachable_bands(costs: DataFrame, minutes: Sequence[int]) -> DataFrame:
    """(source, node, cost) -> (source, minutes, node) for every band the node is within."""
    return costs.withColumn("minutes", F.explode(F.array(*[F.lit(m) for m in minutes]))).filter(
        F.col("cost") <= F.col("minutes") * 60.0
    )


def mode_bands(lengths: DataFrame, modes: dict[str, float], minutes: Sequence[int]) -> DataFrame:
    """(source, node, cost in metres) -> (mode, source, node, cost in seconds, minutes) for every band of every mode.

    One search on length serves all modes: a mode's cost is the length at its speed.
    """
    return _with_bands(lengths, modes, minutes).filter(F.col("cost") <= F.col("minutes") * 60.0)


def band_limits(minutes: Sequence[int], modes: dict[str, float] | None = None) -> list[float]:
    """The largest cost of every band, ascending: in seconds, or in metres with ``modes`` (see ``mode_bands``)."""
    if not modes:
        return sorted({m * 60.0 for m in minutes})
    limits = set()
    for speed in modes.values():
        metres_s = float(speed) * 1000.0 / 3600.0
        for seconds in (m * 60.0 for m in minutes):
            x = seconds * metres_s
            while x / metres_s > seconds:
                x = math.nextafter(x, -math.inf)
            while math.nextafter(x, math.inf) / metres_s <= seconds:
                x = math.nextafter(x, math.inf)
            limits.add(x)
    return sorted(limits)


def _with_bands(lengths: DataFrame, modes: dict[str, float], minutes: Sequence[int]) -> DataFrame:
    arr = F.array(
        *[F.struct(F.lit(m).alias("mode"), F.lit(float(s)).alias("speed"), F.lit(t).alias("minutes")) for m, s in modes.items() for t in minutes]
    )
    return lengths.withColumn("__b", F.explode(arr)).select(
        F.col("__b.mode").alias("mode"),
        *[c for c in lengths.columns if c != "cost"],
        (F.col("cost") / (F.col("__b.speed") * 1000.0 / 3600.0)).alias("cost"),
        F.col("__b.minutes").alias("minutes"),
    )


def node_cells(nodes: DataFrame, cell: int, buffer_m: int) -> DataFrame:
    """(node, cx, cy): the grid cells of size ``cell`` whose centre lies within ``buffer_m`` of the node.

    A node only visits the cells of its own buffer's bounding box.
    """
    lo_x = F.ceil((F.col("x") - buffer_m) / cell - 0.5).cast("long")
    hi_x = F.floor((F.col("x") + buffer_m) / cell - 0.5).cast("long")
    lo_y = F.ceil((F.col("y") - buffer_m) / cell - 0.5).cast("long")
    hi_y = F.floor((F.col("y") + buffer_m) / cell - 0.5).cast("long")
    cells = nodes.select(
        F.col("node_id").alias("node"), "x", "y", F.explode(F.sequence(lo_x, hi_x)).alias("cx"), lo_y.alias("__ly"), hi_y.alias("__hy")
    ).select("node", "x", "y", "cx", F.explode(F.sequence("__ly", "__hy")).alias("cy"))
    # centre of cell (cx, cy) is ((cx + 0.5) * cell, (cy + 0.5) * cell); compare in doubled units to stay integral
    dx = (2 * F.col("cx") + 1) * cell - 2 * F.col("x")
    dy = (2 * F.col("cy") + 1) * cell - 2 * F.col("y")
    return cells.filter(dx * dx + dy * dy <= F.lit(4 * buffer_m * buffer_m)).select("node", "cx", "cy")


def covered_cells(bands: DataFrame, nodes: DataFrame, cell: int, buffer_m: int, keys: Sequence[str] = ()) -> DataFrame:
    """([keys,] source, minutes, cx, cy): the cells covered by the union of ``buffer_m`` discs around reachable nodes."""
    return bands.join(node_cells(nodes, cell, buffer_m), "node").select(*keys, "source", "minutes", "cx", "cy").distinct()


def coverage(
    costs: DataFrame, nodes: DataFrame, cell: int, buffer_m: int, minutes: Sequence[int], modes: dict[str, float] | None = None
) -> DataFrame:
    """([mode,] source, minutes) -> reachable nodes, and the grid cells (and their
    area) covered by the union of ``buffer_m`` discs around them (G6).

    ``costs``: (source, node, cost), in seconds, or in metres with ``modes``.
    The buffered-union polygon becomes a raster.  A cell's cost is the
    smallest among the nodes that cover it, so one aggregate over cells serves
    every band (and every mode): a band counts the cells within its limit.
    """
    ensure_checkpoint_dir(costs.sparkSession)
    cells = node_cells(nodes, cell, buffer_m)
    packed = task_search.states_of(costs)
    counted = None
    if packed is not None and all(speed > 0 for speed in (modes or {}).values()):
        # a source's states are in one task, which takes costs up to the limit of their band
        counted = task_search.counts_by_limit(packed, cells, band_limits(minutes, modes))
    if counted is None:
        costs = costs.select("source", "node", "cost").checkpoint()  # read for nodes and for cells
        reached = costs.select("source", F.lit(True).alias("is_node"), "cost")
        per_cell = costs.join(cells, "node").groupBy("source", "cx", "cy").agg(F.min("cost").alias("cost"))
        # equal costs count once per source and kind before they meet the bands
        counted = reached.unionByName(per_cell.select("source", F.lit(False).alias("is_node"), "cost"))
        counted = counted.groupBy("source", "is_node", "cost").agg(F.count(F.lit(1)).alias("n"))
    banded = mode_bands(counted, modes, minutes) if modes else reachable_bands(counted, minutes)
    k = ["mode"] if modes else []
    per_band = banded.groupBy(*k, "source", "minutes").agg(
        F.sum(F.when(F.col("is_node"), F.col("n")).otherwise(0)).alias("nodes"),
        F.sum(F.when(F.col("is_node"), 0).otherwise(F.col("n"))).alias("cells"),
    )
    return per_band.filter("nodes > 0").withColumn("area_m2", F.col("cells") * (cell * cell))


def latest_isochrones(rings: DataFrame, mode: str, max_minutes: int = 40) -> DataFrame:
    """Rings of one mode up to ``max_minutes``, largest first."""
    return rings.filter((F.col("mode") == mode) & (F.col("minutes") <= max_minutes)).orderBy(
        F.col("minutes").desc(), *[c for c in rings.columns if c not in ("mode", "minutes")]
    )


def route_lines(
    candidates: DataFrame,
    nodes: DataFrame,
    edges: DataFrame,
    target_routes: int,
    weight: str = "length",
) -> DataFrame:
    """Street routes for the first ``target_routes`` candidates that can be
    routed (G5).

    ``candidates``: (cand_idx, start_x, start_y, end_x, end_y, ...) in node
    coordinates.  End points snap to their nearest node (J6); the path is
    the shortest by ``weight`` using the cheapest parallel edge, then the one
    with fewest edges, then with the smallest node ids from the end; repeated
    consecutive points are dropped; distance is the polyline length and
    ``points`` its vertices.  Unreachable candidates and paths of one point are
    skipped, so route numbers can have gaps.  One goal-directed search serves
    all candidates.
    """
    ensure_checkpoint_dir(candidates.sparkSession)
    candidates = candidates.checkpoint()  # read twice (snapping, final join): compute once
    ends = candidates.select(
        (F.col("cand_idx") * 2).alias("pt"), F.col("start_x").alias("x"), F.col("start_y").alias("y")
    ).unionByName(candidates.select((F.col("cand_idx") * 2 + 1).alias("pt"), F.col("end_x").alias("x"), F.col("end_y").alias("y")))
    snapped = nearest(ends, nodes, "pt", "node_id")
    pairs = snapped.groupBy(F.floor(F.col("pt") / 2).cast("long").alias("pair_id")).agg(
        F.max(F.when(F.col("pt") % 2 == 0, F.col("node_id"))).alias("start_node"),
        F.max(F.when(F.col("pt") % 2 == 1, F.col("node_id"))).alias("end_node"),
    ).checkpoint()
    goals = Goals(
        pairs.select(F.col("start_node").alias("source"), F.col("end_node").alias("target")).distinct(),
        landmark_bounds(nodes, edges, weight),
    )
    sources = pairs.select(F.col("start_node").alias("source")).distinct()
    costs = bounded_costs(sources, edges, weight, goals=goals, with_hops=True)
    steps = shortest_paths(pairs, costs, edges, weight)
    pts = steps.join(nodes.select(F.col("node_id").alias("node"), "x", "y"), "node")
    w = Window.partitionBy("pair_id").orderBy("hops")
    pts = pts.withColumn("__px", F.lag("x").over(w)).withColumn("__py", F.lag("y").over(w))
    pts = pts.filter(F.col("__px").isNull() | (F.col("__px") != F.col("x")) | (F.col("__py") != F.col("y")))
    dx, dy = (F.col("x") - F.col("__px")).cast("double"), (F.col("y") - F.col("__py")).cast("double")
    seg = F.when(F.col("__px").isNull(), F.lit(0.0)).otherwise(F.sqrt(dx * dx + dy * dy))
    lines = pts.groupBy("pair_id").agg(F.array_sort(F.collect_list(F.struct("hops", "x", "y", seg.alias("seg")))).alias("points"))
    # added from the start, so that the sum does not depend on the order of rows
    distance = F.aggregate("points", F.lit(0.0), lambda acc, p: acc + p["seg"])
    lines = lines.filter(F.size("points") >= 2).select(
        "pair_id", distance.alias("distance_m"), F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("points")
    )
    chosen = lines.orderBy("pair_id").limit(target_routes)
    return candidates.join(chosen, candidates["cand_idx"] == chosen["pair_id"]).drop("pair_id").withColumn(
        "route_id", F.concat(F.lit("route_"), (F.col("cand_idx") + 1).cast("string"))
    ).withColumn("distance_m", F.rint(F.col("distance_m") * 10.0) / 10.0)
