"""Searches whose graph fits into a task (G3, G6): a task runs all searches of its sources over arrays.

The rounds of ``paths`` deal out, write and read every state again; with sources by the ten thousand
these are billions of rows.  Here only the edges are sent, as arrays, and a source's states leave its
task as one row of arrays, so a state is moved once.  Graphs beyond ``TASK_ARCS`` edges and rasters
beyond ``TASK_CELLS`` pairs of node and cell are left to the rounds and joins.

What runs on executors is nested in functions, so that these need numpy and pyarrow but not this package.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

#: Edges (16 bytes each) and (node, cell) pairs (24 bytes each) that a task may hold.
TASK_ARCS = 4_000_000
TASK_CELLS = 8_000_000
#: Most sources of a task.
TASK_SOURCES = 256
#: States of a batch (a source counts with all nodes), nodes of a row of states, and of the rows sent at once.
BATCH_STATES = 1 << 19
ROW_NODES = 1 << 16
SEND_NODES = 1 << 18


def fits(sources: DataFrame, edges: DataFrame, arcs: DataFrame) -> bool:
    """Whether the searches from ``sources`` over the cheapest edges ``arcs`` of ``edges`` can run in tasks."""
    kinds = [sources.schema["source"].dataType, edges.schema["u"].dataType, edges.schema["v"].dataType]
    return all(isinstance(k, LongType) for k in kinds) and arcs.count() <= TASK_ARCS


def _graph(arcs: DataFrame, cutoff: float) -> tuple[np.ndarray, ...]:
    """(node ids, first edge of each node, edge ends, weights); the number after the last id stands for a null end."""
    # null and NaN weights lead nowhere, as in the rounds
    got = arcs.filter((F.col("w") <= float(cutoff)) & F.col("u").isNotNull()).select("u", "v", "w").toArrow()
    u, w = got["u"].to_numpy(), got["w"].to_numpy()
    null = got["v"].is_null().to_numpy()
    v = got["v"].fill_null(0).to_numpy()
    ids = np.unique(np.concatenate([u, v[~null]])).astype(np.int64)
    start = np.searchsorted(ids, u)
    end = np.where(null, len(ids), np.searchsorted(ids, v))
    order = np.argsort(start, kind="stable")
    first = np.searchsorted(start[order], np.arange(len(ids) + 2))
    return ids, first, end[order].astype(np.int32), w[order].astype(np.float64)


def per_source(sources: DataFrame, arcs: DataFrame, cutoff: float) -> DataFrame:
    """(source, nodes, costs): the nodes within ``cutoff`` of every source.

    A source's rows (one for every ``ROW_NODES`` nodes) follow one another in one partition.
    """
    spark = sources.sparkSession
    graph = spark.sparkContext.broadcast(_graph(arcs, cutoff))
    starts = sources.select("source").distinct().checkpoint()
    # few sources are dealt out as well, eight to a task
    n = starts.count()
    tasks = max(2, -(-n // TASK_SOURCES), min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // 8)))
    dealt = starts.repartitionByRange(tasks, "source")
    run = _searcher(graph, float(cutoff), BATCH_STATES, ROW_NODES, SEND_NODES)
    return dealt.mapInArrow(run, "source long, nodes array<long>, costs array<double>")


def _searcher(graph, cutoff: float, batch_states: int, row_nodes: int, send_nodes: int) -> Callable:
    def search(starts, n, first, end, weight, best, stamp):
        """States (search * n + node) within the cutoff and their costs; ``best`` is left infinite.

        All searches of a batch go on together, by the edges of the states that became cheaper.
        """
        shift = np.arange(len(starts)) * n
        at = shift + starts
        node, cost = starts, np.zeros(len(starts))
        best[at] = 0.0
        seen = [at]
        while len(at):
            lo = first[node]
            many = first[node + 1] - lo
            last = np.cumsum(many)
            edge = np.arange(last[-1]) + np.repeat(lo - last + many, many)
            to = end[edge]
            cand = np.repeat(cost, many) + weight[edge]
            state = np.repeat(at - node, many) + to
            old = best[state]
            less = np.flatnonzero((cand < old) & (cand <= cutoff))
            state, cand, old, to = state[less], cand[less], old[less], to[less]
            np.minimum.at(best, state, cand)
            # of edges that reach a state equally cheap, one goes on
            won = np.flatnonzero(best[state] == cand)
            stamp[state[won]] = won
            won = won[stamp[state[won]] == won]
            at, node, cost = state[won], to[won].astype(np.int64), cand[won]
            seen.append(at[old[won] == np.inf])
        states = np.concatenate(seen)
        states.sort()
        costs = best[states]
        best[states] = np.inf
        return states, costs

    def rows(source, known, nodes, costs, ends):
        """Record batches of rows with the nodes from ``ends[i]`` to ``ends[i + 1]``."""
        cuts = [(i, lo, min(lo + row_nodes, ends[i + 1])) for i in range(len(ends) - 1) for lo in range(ends[i], ends[i + 1], row_nodes)]
        while cuts:
            take = 1
            while take < len(cuts) and cuts[take][2] - cuts[0][1] <= send_nodes:
                take += 1
            some, cuts = cuts[:take], cuts[take:]
            lo, hi = some[0][1], some[-1][2]
            offsets = pa.array([c[1] - lo for c in some] + [hi - lo], pa.int32())
            which = [c[0] for c in some]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(source[which], mask=~known[which]),
                    pa.ListArray.from_arrays(offsets, nodes.slice(lo, hi - lo)),
                    pa.ListArray.from_arrays(offsets, pa.array(costs[lo:hi])),
                ],
                names=["source", "nodes", "costs"],
            )

    def run(batches):
        ids, first, end, weight = graph.value
        n = len(ids) + 1
        names = np.append(ids, 0)
        width = max(1, min(64, batch_states // n))
        best, stamp = np.full(width * n, np.inf), np.zeros(width * n, np.int64)
        for batch in batches:
            column = batch.column(0)
            known = ~column.is_null().to_numpy(zero_copy_only=False)
            source = column.fill_null(0).to_numpy()
            place = np.minimum(np.searchsorted(ids, source), max(0, len(ids) - 1))
            inside = known & (ids[place] == source) if len(ids) else np.zeros(len(source), bool)
            # a source outside the graph reaches itself only; so does a null one, a node without edges
            alone = np.flatnonzero(~inside)
            if len(alone):
                itself = pa.array(source[alone], mask=~known[alone])
                yield from rows(source[alone], known[alone], itself, np.zeros(len(alone)), range(len(alone) + 1))
            asked = np.flatnonzero(inside)
            for lo in range(0, len(asked), width):
                some = asked[lo : lo + width]
                states, costs = search(place[some], n, first, end, weight, best, stamp)
                node = states % n
                ends = np.searchsorted(states, np.arange(len(some) + 1) * n).tolist()
                nodes = pa.array(names[node], mask=node == n - 1)
                yield from rows(source[some], known[some], nodes, costs, ends)

    return run


def exploded(packed: DataFrame) -> DataFrame:
    """(source, node, cost) of the rows of ``per_source``, which ``states_of`` gives back."""
    each = packed.select("source", "costs", F.posexplode("nodes").alias("at", "node"))
    out = each.select("source", "node", F.col("costs")[F.col("at")].alias("cost"))
    out._per_source = packed
    return out


def states_of(costs: DataFrame) -> DataFrame | None:
    """The rows of arrays that ``costs`` was made from, if it was."""
    return getattr(costs, "_per_source", None)


def _raster(cells: DataFrame) -> tuple[np.ndarray, ...]:
    """(node ids; first pair of each node, its cells; first pair of each cell, its nodes' numbers)."""
    got = cells.toArrow()
    xs, x = np.unique(got["cx"].to_numpy(), return_inverse=True)
    ys, y = np.unique(got["cy"].to_numpy(), return_inverse=True)
    cell = np.unique(x * len(ys) + y, return_inverse=True)[1].astype(np.int32)
    ids, node = np.unique(got["node"].to_numpy(), return_inverse=True)
    by_node, by_cell = np.argsort(node, kind="stable"), np.argsort(cell, kind="stable")
    of_node = np.searchsorted(node[by_node], np.arange(len(ids) + 1))
    of_cell = np.searchsorted(cell[by_cell], np.arange(int(cell.max(initial=-1)) + 1))
    return ids, of_node, cell[by_node], of_cell, node[by_cell].astype(np.int32)


def counts_by_limit(packed: DataFrame, cells: DataFrame, limits: Sequence[float]) -> DataFrame | None:
    """(source, is_node, cost, n): the nodes, and the cells by their cheapest node, within each of the
    ascending ``limits`` and not within the one before; ``cost`` is the limit.  None where the cells do not fit.

    ``cells``: (node, cx, cy).
    """
    cells = cells.filter("node IS NOT NULL")
    if cells.count() > TASK_CELLS:
        return None
    raster = packed.sparkSession.sparkContext.broadcast(_raster(cells))
    schema = "source long, is_node boolean, cost double, n long"
    return packed.mapInArrow(_counter(raster, [float(x) for x in limits]), schema)


def _counter(raster, limits: list[float]) -> Callable:
    def run(batches):
        ids, of_node, cells, of_cell, nodes = raster.value
        dense = len(ids) and int(ids[-1]) - int(ids[0]) < 8 * len(ids) + 1024
        number = np.full(int(ids[-1]) - int(ids[0]) + 1 if dense else 0, -1, np.int64)
        if dense:
            number[ids - ids[0]] = np.arange(len(ids))
        by_node, by_cell, stamp = np.full(len(ids), np.inf), np.full(len(of_cell), np.inf), np.zeros(len(of_cell), np.int64)

        def numbered(node):
            """Numbers of the nodes that have cells, and which ones these are."""
            if not len(ids):
                return node[:0], np.zeros(len(node), bool)
            if dense:
                near = (node >= ids[0]) & (node <= ids[-1])
                found = np.where(near, number[np.where(near, node - ids[0], 0)], -1)
                return found[found >= 0], found >= 0
            found = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
            has = ids[found] == node
            return found[has], has

        def cheapest(node, cost):
            """The cost of every cell that the nodes cover."""
            node, has = numbered(node)
            cost = cost[has]
            many = of_node[node + 1] - of_node[node]
            # six steps a pair by the nodes reached, one by all cells
            if 6 * many.sum() > len(nodes):
                by_node[node] = cost
                out = np.minimum.reduceat(by_node[nodes], of_cell)
                by_node[node] = np.inf
                return out
            last = np.cumsum(many)
            pair = np.arange(many.sum()) + np.repeat(of_node[node] - last + many, many)
            cell = cells[pair]
            np.minimum.at(by_cell, cell, np.repeat(cost, many))
            stamp[cell] = np.arange(len(cell))
            cell = cell[stamp[cell] == np.arange(len(cell))]
            out = by_cell[cell]
            by_cell[cell] = np.inf
            return out

        def counted(costs):
            """Numbers of the costs within each limit, less those within the one before."""
            return np.diff([0] + [np.count_nonzero(costs <= x) for x in limits]).tolist()

        out = []

        def finish(source, parts):
            node, known, cost = (np.concatenate(p) for p in zip(*parts))
            covered = cheapest(node[known], cost[known])
            for is_node, values in ((True, cost), (False, covered)):
                out.extend((source, is_node, x, k) for x, k in zip(limits, counted(values)) if k)

        def send():
            columns = zip(*out) if out else [[]] * 4
            kinds = (pa.int64(), pa.bool_(), pa.float64(), pa.int64())
            made = pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["source", "is_node", "cost", "n"])
            out.clear()
            return made

        now, parts = None, []
        for batch in batches:
            source, node, cost = batch.column(0).to_pylist(), batch.column(1), batch.column(2)
            for i, s in enumerate(source):
                if parts and s != now:
                    finish(now, parts)
                    parts = []
                now, ids_of = s, node[i].values
                known = ~ids_of.is_null().to_numpy(zero_copy_only=False)
                parts.append((ids_of.fill_null(0).to_numpy(), known, cost[i].values.to_numpy()))
            yield send()
        if parts:
            finish(now, parts)
        yield send()

    return run
