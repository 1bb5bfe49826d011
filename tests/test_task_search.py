"""Searches inside tasks against the rounds of ``paths``."""

import random

import pytest

from citybeat.operators import network, paths, task_search

SOURCES = "source long"
EDGES = "u long, v long, w double"


def _states(df):
    return sorted(map(tuple, df.select("source", "node", "cost").collect()), key=str)


def _inputs(spark, n=60, seed=21):
    """Weights of zero, parallel and null edges, ends without a node, sources that repeat, are null or lie outside the graph."""
    rnd = random.Random(seed)
    edges = [(rnd.randrange(n) * 10**9, rnd.randrange(n) * 10**9, float(rnd.randint(0, 9)) / 7) for _ in range(3 * n)]
    edges += [(0, None, 0.5), (0, None, 0.3), (None, 0, 0.1), (0, 10**9, None), (10**9, 5, float("nan")), (2 * 10**9, 3, 100.0)]
    sources = [(i * 10**9,) for i in range(0, n, 2)] + [(0,), (None,), (77,), (3,)]
    return spark.createDataFrame(sources, SOURCES), spark.createDataFrame(edges, EDGES)


@pytest.mark.parametrize(("batch", "row", "send", "task"), [(1 << 19, 1 << 16, 1 << 18, 256), (200, 4, 6, 7), (1, 1, 1, 1)])
def test_task_search_matches_rounds(spark, monkeypatch, batch, row, send, task):
    src, edges = _inputs(spark)
    with monkeypatch.context() as m:
        m.setattr(task_search, "TASK_ARCS", 0)
        by_rounds = paths.bounded_costs(src, edges, "w", cutoff=3.0)
        assert task_search.states_of(by_rounds) is None
        want = _states(by_rounds)
    for name, value in (("BATCH_STATES", batch), ("ROW_NODES", row), ("SEND_NODES", send), ("TASK_SOURCES", task)):
        monkeypatch.setattr(task_search, name, value)
    got = paths.bounded_costs(src, edges, "w", cutoff=3.0)
    assert _states(got) == want
    # a source's rows follow one another, none in two partitions
    parts = task_search.states_of(got).select("source").rdd.mapPartitions(lambda rows: [[r.source for r in rows]]).collect()
    runs = [s for p in parts for i, s in enumerate(p) if i == 0 or p[i - 1] != s]
    assert len(runs) == len(set(runs))


def test_search_with_a_cutoff_runs_no_round(spark, monkeypatch):
    monkeypatch.setattr(paths, "round_candidates", lambda *a: pytest.fail("a round"))
    src, edges = _inputs(spark)
    assert paths.bounded_costs(src, edges, "w", cutoff=1.0).count() > 30
    empty = spark.createDataFrame([], EDGES)
    assert _states(paths.bounded_costs(src.limit(1), empty, "w", cutoff=1.0)) == [(0, 0, 0.0)]
    assert paths.bounded_costs(src.limit(0), edges, "w", cutoff=1.0).collect() == []


@pytest.mark.parametrize("modes", [None, {"walk": 4.8, "ride": 15.0}])
@pytest.mark.parametrize("span", [60, 3000])
def test_coverage_in_tasks_matches_joins(spark, monkeypatch, modes, span):
    """Wide and narrow reach, nodes that repeat, lie elsewhere, or have no place, and sources in several rows."""
    rnd = random.Random(22)
    n, step = span, 1 if span < 100 else 10**9
    edges = [(i * step, (i + k) % n * step, float(rnd.randint(20, 200))) for i in range(n) for k in (1, 2)] + [(0, None, 3.0)]
    nodes = [(i * step, i % 50 * 37, i // 50 * 41) for i in range(0, n, 3)] + [(0, 9, 900), (0, 9, 900), (None, 3, 3), (step, None, 5), (-7, 3, 3)]
    edf, ndf = spark.createDataFrame(edges, EDGES), spark.createDataFrame(nodes, "node_id long, x long, y long")
    src = spark.createDataFrame([(i * step,) for i in range(0, n, n // 20)] + [(None,), (77,)], SOURCES)
    monkeypatch.setattr(task_search, "ROW_NODES", 5)
    costs = paths.bounded_costs(src, edf, "w", cutoff=2500.0)
    args = (ndf, 10, 25, [5, 10], modes)
    got = network.coverage(costs, *args).collect()
    with monkeypatch.context() as m:
        m.setattr(task_search, "TASK_CELLS", 0)
        want = network.coverage(costs, *args).collect()
    assert len(got) > 20 and sorted(map(str, got)) == sorted(map(str, want))
    assert costs.select("*").schema == costs.schema and task_search.states_of(costs.select("*")) is None


def test_coverage_joins_no_states_that_tasks_hold(spark):
    src, edges = _inputs(spark)
    costs = paths.bounded_costs(src, edges, "w", cutoff=1.0)
    nodes = spark.createDataFrame([(i * 10**9, i, i) for i in range(60)], "node_id long, x long, y long")
    out = network.coverage(costs, nodes, 10, 25, [5])
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Join" not in plan
    assert out.count() == costs.select("source").distinct().count()


def test_band_limits_are_the_largest_costs():
    import math

    modes = {"a": 4.8, "b": 15.0, "c": 25.0, "d": 7.3, "e": 0.1}
    limits = network.band_limits([5, 10, 7], modes)
    assert limits == sorted(set(limits)) and len(limits) == 15
    largest = [x for s in modes.values() for t in (5, 10, 7) for x in limits if x / (s * 1000.0 / 3600.0) <= t * 60.0 < math.nextafter(x, math.inf) / (s * 1000.0 / 3600.0)]
    assert sorted(largest) == limits
