"""Shortest paths over edge tables (G3, G5): banded multi-source search,
landmark bounds, goal-directed search and path recovery.

State rows are (keys, source, node, cost[, hops]): cheapest first, then fewest
edges.  They are kept in a log table: every round appends the rows that
improved, bucketed on the state's key, so a round writes what changed and
nothing else, and the smallest row of a state is an aggregate without a
shuffle.  The cheapest edges are written once, bucketed on
their start node with the same number of buckets, so a round joins its frontier
to them without moving an edge.

The search settles one cost band after the other (delta stepping): within a
band, improved rows are extended until no row of the band changes; rows beyond
it wait in the log.  A band is final when the next begins.

With ``Goals`` only rows that may still lie on a shortest path to an open
target go on: a source ends when the band passes its targets, and a row whose
cost plus lower bound to the targets exceeds the best known cost is left out.
Lower bounds come from landmarks: d(x, t) >= d(L, t) - d(L, x) and
d(x, t) >= d(x, L) - d(t, L).

A search with a cutoff over a graph that fits into a task needs no rounds: every
task runs those of its sources (``task_search``).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from citybeat.operators import task_search
from citybeat.session import ensure_checkpoint_dir, scratch_path

INF = float("inf")
#: Mean weights in a cost band.
BAND = 16.0


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class BucketedTable:
    """A table in the shared folder, bucketed on ``by``, to which rows are added."""

    def __init__(self, spark: SparkSession, name: str, by: Sequence[str]) -> None:
        self.spark, self.by, self.n = spark, list(by), _buckets(spark)
        self.name = f"citybeat_{name}_{uuid.uuid4().hex[:12]}"
        self.path = scratch_path(spark, name)

    def write(self, df: DataFrame) -> BucketedTable:
        # one file a bucket
        df = df.repartition(self.n, *self.by)
        df.write.format("parquet").bucketBy(self.n, *self.by).option("path", self.path).saveAsTable(self.name)
        return self

    def append(self, df: DataFrame) -> None:
        """Add rows with the columns of ``write``, in their order."""
        df.write.insertInto(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Forget the name; the files stay in the scratch folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


@dataclass
class Goals:
    """Pairs (source, target) a search has to settle, with landmark columns per node (see ``landmark_bounds``)."""

    targets: DataFrame
    bounds: DataFrame

    def _marks(self) -> list[str]:
        return [c for c in self.bounds.columns if c.startswith("from_")]

    def open(self, best: DataFrame, settled: float) -> DataFrame:
        """Per source its targets not settled below the cost ``settled``, as one row that bounds them all: the
        largest known cost and, per landmark, the smallest and largest distance.  Holds for the band to come."""
        got = best.select("source", F.col("node").alias("target"), F.col("cost").alias("reached"))
        still = self.targets.join(got, ["source", "target"], "left").filter(
            F.col("reached").isNull() | (F.col("reached") >= settled)
        )
        per_source = still.join(self.bounds.withColumnRenamed("node", "target"), "target", "left").groupBy("source")
        return per_source.agg(
            F.max(F.coalesce("reached", F.lit(INF))).alias("__until"),
            *[F.min(F.coalesce(c, F.lit(INF))).alias(f"__{c}") for c in self._marks()],
            *[F.max(F.coalesce(_back(c), F.lit(INF))).alias(f"__{_back(c)}") for c in self._marks()],
        ).checkpoint()

    def pruned(self, rows: DataFrame, targets: DataFrame) -> DataFrame:
        """The ``rows`` that may lie on a shortest path to one of the open ``targets``."""
        lower = F.greatest(
            F.lit(0.0),
            *[_known(F.col(f"__{c}") - F.coalesce(c, F.lit(INF))) for c in self._marks()],
            *[_known(F.coalesce(_back(c), F.lit(INF)) - F.col(f"__{_back(c)}")) for c in self._marks()],
        )
        near = rows.join(targets, "source").join(self.bounds, "node", "left")
        # an infinite bound: no path to any open target; the factor takes up rounding of sums
        may = (lower < INF) & (F.col("cost") + lower <= F.col("__until") * (1 + 1e-9))
        return near.filter(may).select(*rows.columns)


def _back(column: str) -> str:
    return column.replace("from_", "to_")


def _known(c: Column) -> Column:
    """0 where a difference says nothing (both parts infinite)."""
    return F.nanvl(c, F.lit(0.0))


def cheapest(edges: DataFrame, weight: str, keys: Sequence[str] = ()) -> DataFrame:
    """One edge per (keys, u, v): the cheapest of the parallel edges, ``w``."""
    return edges.groupBy(*keys, "u", "v").agg(F.min(weight).cast("double").alias("w"))


def _best(log: DataFrame, state: Sequence[str]) -> DataFrame:
    """The smallest row of every state in the log."""
    if "hops" not in log.columns:
        return log.groupBy(*state).agg(F.min("cost").alias("cost"))
    return log.groupBy(*state).agg(F.min(F.struct("cost", "hops")).alias("__k")).select(*state, "__k.cost", "__k.hops")


def round_candidates(
    frontier: DataFrame, arcs: DataFrame, state: Sequence[str], hi: float, cutoff: float | None, hops: int
) -> DataFrame:
    """What ``frontier`` reaches by up to ``hops`` edges: (state, cost[, hops], todo), the smallest row a state.

    Only rows inside the band take a second step; ``todo`` marks rows that were not extended.
    """
    keys = list(state[:-2])
    count = ["hops"] if "hops" in frontier.columns else []
    links = arcs.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("u").alias("__u"), F.col("v").alias("__v"), "w")
    steps, reach = None, frontier.select(*state, "cost", *count)
    for hop in range(hops):
        on = F.col("node") == F.col("__u")
        for k in keys:
            on = on & (F.col(k) == F.col(f"__{k}"))
        step = reach.join(links, on).select(
            *keys,
            "source",
            F.col("__v").alias("node"),
            (F.col("cost") + F.col("w")).alias("cost"),
            *[(F.col(c) + 1).alias(c) for c in count],
            F.lit(hop == hops - 1).alias("todo"),
        )
        if cutoff is not None:
            step = step.filter(F.col("cost") <= float(cutoff))
        steps = step if steps is None else steps.unionByName(step)
        reach = step.filter(F.col("cost") < hi).select(*state, "cost", *count)
    if count:
        least = steps.groupBy(*state).agg(F.min(F.struct("cost", "hops", "todo")).alias("__c")).select(*state, "__c.*")
    else:
        least = steps.groupBy(*state).agg(F.min("cost").alias("cost"), F.min(F.when(~F.col("todo"), F.col("cost"))).alias("__went"))
        least = least.select(*state, "cost", (F.col("__went").isNull() | (F.col("cost") < F.col("__went"))).alias("todo"))
    return least.withColumn("todo", F.col("todo") | (F.col("cost") >= hi))


def improved(cands: DataFrame, log: DataFrame, state: Sequence[str]) -> DataFrame:
    """The candidates that are smaller than their state's row in the log."""
    measure = [c for c in cands.columns if c in ("cost", "hops")]
    known = _best(log, state).select(*[F.col(c).alias(f"__{c}") for c in [*state, *measure]])
    on = F.lit(True)
    for c in state:
        on = on & (F.col(c) == F.col(f"__{c}"))
    old = F.struct(*[F.col(f"__{c}").alias(c) for c in measure])
    fresh = F.col("__cost").isNull() | (F.struct(*measure) < old)
    return cands.join(known, on, "left").filter(fresh).select(*state, *measure, "todo")


def bounded_costs(
    sources: DataFrame,
    edges: DataFrame,
    weight: str,
    cutoff: float | None = None,
    keys: Sequence[str] = (),
    band: float | None = None,
    hops: int = 2,
    goals: Goals | None = None,
    with_hops: bool = False,
) -> DataFrame:
    """([keys,] source, node, cost[, hops]) for every node reachable from each
    source with total ``weight`` (not negative) <= ``cutoff`` (G3).

    ``sources`` has the columns ``keys`` and ``source`` (a node id), ``edges``
    ``keys``, u, v and ``weight``: every key runs its own search in the same
    rounds.  ``band`` is the width of a cost band (default: ``BAND`` mean
    weights), ``hops`` the edges a round takes inside a band; neither changes
    the result.  With ``goals`` only the states on shortest paths to the
    targets, and what the search met on its way, are in the result.
    """
    spark = sources.sparkSession
    ensure_checkpoint_dir(spark)
    state = [*keys, "source", "node"]
    arcs = BucketedTable(spark, "arcs", [*keys, "u"]).write(cheapest(edges, weight, keys))
    if cutoff is not None and goals is None and not keys and not with_hops and task_search.fits(sources, edges, arcs.read()):
        costs = task_search.exploded(task_search.per_source(sources, arcs.read(), cutoff))
        arcs.drop()
        return costs
    band = band or BAND * float(arcs.read().agg(F.avg("w")).first()[0] or 0.0) or 1.0
    log = BucketedTable(spark, "costs", state)
    start = sources.select(*keys, "source", F.col("source").alias("node")).distinct()
    count = [F.lit(0).alias("hops")] if with_hops else []
    log.write(start.select(*state, F.lit(0.0).alias("cost"), *count, F.lit(True).alias("todo"), F.lit(0).alias("round")))
    number, lo, hi = 0, 0.0, band
    frontier = log.read()
    targets = goals.open(frontier, 0.0) if goals else None
    while True:
        if goals is not None:
            frontier = goals.pruned(frontier, targets)
        number += 1
        cands = round_candidates(frontier, arcs.read(), state, hi, cutoff, hops)
        inside = F.col("todo") & (F.col("cost") < hi)
        seen = Observation()
        rows = improved(cands, log.read(), state).withColumn("round", F.lit(number))
        log.append(rows.observe(seen, F.count_if(inside).alias("inside")))
        if seen.get["inside"]:
            frontier = log.read().filter((F.col("round") == number) & inside)
            continue
        best = _best(log.read(), state)
        ahead = best.filter(F.col("cost") >= hi)
        if goals is not None:
            # rows that lead to no open target do not open a band
            targets = goals.open(best, hi)
            ahead = goals.pruned(ahead, targets)
        least = ahead.agg(F.min("cost")).first()[0] if cutoff is None or cutoff >= hi else None
        if least is None:
            break
        lo = max(hi, least // band * band)
        hi = lo + band
        frontier = best.filter((F.col("cost") >= lo) & (F.col("cost") < hi))
    arcs.drop()
    return _best(log.read(), state)


def landmark_bounds(nodes: DataFrame, edges: DataFrame, weight: str) -> DataFrame:
    """(node, from_0.., to_0..): distances from and to the four corner nodes, infinite where there is no path.

    A node without a path to or from any of them has no row.
    """
    ways = [F.col("x") + F.col("y"), F.col("x") - F.col("y"), -F.col("x") + F.col("y"), -F.col("x") - F.col("y")]
    corners = F.array(*[F.min_by("node_id", F.struct(w.alias("w"), "node_id")) for w in ways])
    marks = nodes.agg(corners.alias("c")).select(F.posexplode("c").alias("mark", "source")).filter("source IS NOT NULL").checkpoint()
    both = edges.select(F.lit("from").alias("way"), "u", "v", weight).unionByName(
        edges.select(F.lit("to").alias("way"), F.col("v").alias("u"), F.col("u").alias("v"), weight)
    )
    starts = marks.select(F.explode(F.array(F.lit("from"), F.lit("to"))).alias("way"), "source").distinct()
    costs = bounded_costs(starts, both, weight, keys=["way"]).join(marks, "source")
    columns = [
        F.coalesce(F.min(F.when((F.col("way") == way) & (F.col("mark") == i), F.col("cost"))), F.lit(INF)).alias(f"{way}_{i}")
        for way in ("from", "to")
        for i in range(len(ways))
    ]
    return costs.groupBy("node").agg(*columns).checkpoint()


def shortest_paths(pairs: DataFrame, costs: DataFrame, edges: DataFrame, weight: str) -> DataFrame:
    """(pair_id, hops, node): the nodes of the shortest path of every (pair_id, start_node, end_node) that has one.

    ``costs`` is a search with hops from the start nodes.  Of equally short
    paths with equally many edges the one with the smallest node ids, read
    from the end, is taken.  The end node's way back doubles every round
    (pointer jumping over the predecessors), and a round writes only new rows.
    """
    spark = pairs.sparkSession
    arcs = cheapest(edges, weight)
    at = costs.select("source", F.col("node").alias("v"), F.col("cost").alias("c"), F.col("hops").alias("h"))
    before = costs.select(F.col("source").alias("s"), F.col("node").alias("u"), "cost", "hops")
    fits = (F.col("source") == F.col("s")) & (F.col("cost") + F.col("w") == F.col("c")) & (F.col("hops") + 1 == F.col("h"))
    jump = (
        at.join(arcs, "v").join(before, "u").filter(fits).groupBy("source", F.col("v").alias("node")).agg(F.min("u").alias("back"))
    ).checkpoint()
    path = scratch_path(spark, "paths")
    ends = pairs.select("pair_id", F.col("start_node").alias("source"), F.col("end_node").alias("node"))
    ends = ends.join(costs.select("source", "node", "hops"), ["source", "node"]).select("source", "node", "pair_id", "hops")
    ends.write.parquet(path)
    width = 1
    while True:
        have = spark.read.schema(ends.schema).parquet(path)
        step = have.join(jump, ["source", "node"]).select(
            "source", F.col("back").alias("node"), "pair_id", (F.col("hops") - width).alias("hops")
        ).checkpoint()
        if step.isEmpty():
            return have.select("pair_id", "hops", "node")
        step.write.mode("append").parquet(path)
        far = jump.select("source", F.col("node").alias("back"), F.col("back").alias("further"))
        jump = jump.join(far, ["source", "back"]).select("source", "node", F.col("further").alias("back")).checkpoint()
        width *= 2
