"""Overlapping routes as groups (J7): routes that share segments, directly or over others.

A segment with n routes gives n - 1 links, each route to the segment's smallest
one; all pairs of a segment would give the same groups.  Groups are the
connected components, found by contraction: a round merges every route into the
end of its way over smallest neighbours and goes on with the links left between
different routes, so that the links are read once or twice at full size.  The
driver only sees whether links are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.operators.spatial import route_segments
from citybeat.session import ensure_checkpoint_dir


def shared_segments(route_points: DataFrame) -> DataFrame:
    """(seg, first_route, last_route, n_routes): every segment that more than one route uses, with one pair of them."""
    uses = route_segments(route_points).distinct()
    per_seg = uses.groupBy("seg").agg(
        F.min("route_id").alias("first_route"), F.max("route_id").alias("last_route"), F.count(F.lit(1)).alias("n_routes")
    )
    return per_seg.filter("n_routes > 1")


def _roots(hooks: DataFrame) -> DataFrame:
    """(node, label): the last node on the way from every node of ``hooks`` (node, label), whose labels are smaller nodes.

    Only nodes that others hang on are followed (pointer jumping); the rest take the root of their label.
    """
    inner = hooks.join(hooks.select(F.col("label").alias("node")).distinct(), "node", "left_semi").checkpoint()
    while True:
        beyond = inner.select(F.col("node").alias("label"), F.col("label").alias("far"))
        jumped = inner.join(beyond, "label", "left").select("node", F.coalesce("far", "label").alias("label"), F.col("far").isNotNull().alias("moved"))
        jumped = jumped.checkpoint()
        inner = jumped.select("node", "label")
        if jumped.filter("moved").isEmpty():
            break
    roots = inner.select(F.col("node").alias("label"), F.col("label").alias("far"))
    return hooks.join(roots, "label", "left").select("node", F.coalesce("far", "label").alias("label"))


def smallest_labels(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (a, b): the smallest node of its component.

    A round merges every node into the smallest node it reaches by ever smaller
    neighbours and renames the links, of which those between different nodes
    go on: the graph shrinks every round, and a smallest node keeps its name.
    """
    ensure_checkpoint_dir(links.sparkSession)
    known = links.filter("a IS NOT NULL AND b IS NOT NULL")
    open_links = known.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    rounds: list[DataFrame] = []
    while not open_links.isEmpty():
        hooks = open_links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("label")).checkpoint()
        names = _roots(hooks).checkpoint()
        rounds.append(names)
        renamed = open_links
        for end in ("u", "v"):
            to = names.select(F.col("node").alias(end), F.col("label").alias("to"))
            renamed = renamed.join(to, end, "left").withColumn(end, F.coalesce("to", end)).drop("to")
        renamed = renamed.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        open_links = renamed.distinct().checkpoint()
    # from the last round back: every table names the nodes of the one before
    final: DataFrame | None = None
    for names in reversed(rounds):
        if final is None:
            final = names
            continue
        later = final.select(F.col("node").alias("label"), F.col("label").alias("to"))
        final = names.join(later, "label", "left").select("node", F.coalesce("to", "label").alias("label")).unionByName(
            final.join(names.select("node"), "node", "left_anti")
        ).checkpoint()
    nodes = known.select(F.inline(F.array(F.struct(F.col("a").alias("node")), F.struct(F.col("b").alias("node"))))).distinct()
    if final is None:
        return nodes.select("node", F.col("node").alias("label"))
    return nodes.join(final, "node", "left").select("node", F.coalesce("label", "node").alias("label")).checkpoint()


def route_groups(route_points: DataFrame) -> DataFrame:
    """Per route: its group (the smallest route of it), the group's routes and links.

    A route that shares no segment is a group of its own without links.
    """
    ensure_checkpoint_dir(route_points.sparkSession)
    uses = route_segments(route_points).distinct().checkpoint()  # read for the links and their first routes
    first = uses.groupBy("seg").agg(F.min("route_id").alias("a"))
    links = uses.join(first, "seg").filter(F.col("a") < F.col("route_id")).select("a", F.col("route_id").alias("b")).distinct().checkpoint()
    labels = smallest_labels(links).select(F.col("node").alias("route_id"), F.col("label").alias("group_id"))
    n_links = links.join(labels, links["a"] == labels["route_id"]).groupBy("group_id").agg(F.count(F.lit(1)).alias("group_links"))
    sizes = labels.groupBy("group_id").agg(F.count(F.lit(1)).alias("group_size")).join(n_links, "group_id")
    routes = route_points.select("route_id").distinct()
    return routes.join(labels.join(sizes, "group_id"), "route_id", "left").select(
        "route_id",
        F.coalesce("group_id", "route_id").alias("group_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce("group_links", F.lit(0)).cast("long").alias("group_links"),
    )
