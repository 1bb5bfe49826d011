"""Hand-made fixtures for the operators (SURVEY section 5 (b)-(d))."""

import datetime as dt
import heapq
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from citybeat.operators import bikes, common, groups, leaf_index, network, outline, paths, polygons, reports, sampling, spatial, taxi, traffic
from citybeat.sources.trips import normalize_trips, union_groups

YEARS = (2023, 2024)


def _trip_groups(spark):
    yellow = spark.createDataFrame(
        [
            (dt.datetime(2024, 1, 1, 8), dt.datetime(2024, 1, 1, 8, 10), 1.0, 10.0, 0.0, 1.0, 0.5, 132, 1),
            (dt.datetime(2024, 1, 1, 9), dt.datetime(2024, 1, 1, 9, 5), 0.0, 10.0, 2.0, None, 0.0, 132, 2),
            (dt.datetime(2024, 1, 2, 9), dt.datetime(2024, 1, 2, 8, 0), 2.0, 0.0, 1.0, 0.0, 0.0, 138, 1),
            (dt.datetime(2019, 1, 2, 9), dt.datetime(2019, 1, 2, 9, 1), 3.0, 5.0, 1.0, 0.0, 0.0, 1, 1),
        ],
        "tpep_pickup_datetime timestamp, tpep_dropoff_datetime timestamp, trip_distance double, fare_amount double, "
        "tip_amount double, airport_fee double, extra double, PULocationID int, RatecodeID int",
    )
    fhv = spark.createDataFrame(
        [("2024-01-01 10:00:00", 1, "1", 1), ("2024-01-01 11:00:00", 2, None, 1), ("bad", 3, "1", 1)],
        "pickup_datetime string, PUlocationID int, SR_Flag string, DOlocationID int",
    )
    hv = spark.createDataFrame(
        [
            (1704103200000, 600, " y", "HV0003", 4.0, 20.0),
            (1704103200000, 60, "N", "HV0005", 4.0, 20.0),
            (1704103200000, 60, None, " ", 4.0, 20.0),
            (1704103200000, 60, "Y", "HV0009", 4.0, 20.0),
        ],
        "pickup_datetime long, trip_time long, shared_match_flag string, hvfhs_license_num string, trip_miles double, base_passenger_fare double",
    )
    fields_y = ["pickup_datetime", "dropoff_datetime", "trip_distance", "base_fare", "tip_amount", "airport_fee", "extra", "ratecode", "PULocationID"]
    fields_f = ["pickup_datetime", "PULocationID", "DOLocationID", "shared_match_flag"]
    fields_h = ["pickup_datetime", "trip_time", "shared_match_flag", "provider", "trip_distance", "base_fare"]
    return union_groups(
        [
            normalize_trips(yellow, "yellow", "yellow", fields_y, *YEARS),
            normalize_trips(fhv, "fhv", "fhv", fields_f, *YEARS),
            normalize_trips(hv, "hvfhs", "hvfhs", fields_h, *YEARS),
        ]
    )


def _rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_schema_drift_groups_and_year_filter(spark):
    t = _trip_groups(spark)
    assert _rows(taxi.monthly_volume(t), "service", "year", "month", "trips") == [
        ("fhv", 2024, 1, 2), ("hvfhs", 2024, 1, 4), ("yellow", 2024, 1, 3),
    ]
    dur = {(r.service, r.duration_bin): r.trips for r in taxi.duration_bins(t).collect()}
    # yellow: 10 min and 5 min from dropoff - pickup (the negative one dropped); hvfhs from trip_time
    assert dur[("yellow", "10-20")] == 1 and dur[("yellow", "5-10")] == 1 and dur[("yellow", "0-5")] == 0
    assert dur[("hvfhs", "10-20")] == 1 and dur[("hvfhs", "0-5")] == 3
    assert not any(s == "fhv" for s, _ in dur)  # no duration source in the fhv group


def test_distance_bins_zero_fill_only_for_services_with_rows(spark):
    t = _trip_groups(spark)
    d = _rows(taxi.distance_bins(t), "service", "distance_bin", "trips")
    services = {s for s, _, _ in d}
    assert services == {"yellow", "hvfhs"}
    assert ("yellow", "0-1", 0) in d and ("yellow", "1-2", 1) in d and ("yellow", "2-5", 1) in d
    assert sum(n for s, _, n in d if s == "yellow") == 2  # distance 0 is outside (0, 200)


def test_tip_zero_bucket_and_components(spark):
    t = _trip_groups(spark)
    tips = _rows(taxi.tip_rate_bins(t), "service", "tip_bin", "trips")
    assert ("hvfhs", "0%", 4) not in tips  # no tip column in the hvfhs group -> no rate
    assert ("yellow", "20-25%", 1) in tips and ("yellow", "0%", 0) not in tips
    comps = {(r.service, r.component): r.avg_amount for r in taxi.fare_components(t).collect()}
    assert ("fhv", "Base fare") not in comps
    assert comps[("yellow", "Base fare")] == round(20.0 / 3, 4)
    assert comps[("yellow", "Surcharges")] == 0.5  # (0.5 + 1.0) / 3 trips; the null airport fee counts as 0
    assert ("yellow", "Tolls") not in comps


def test_airport_shared_provider(spark):
    t = _trip_groups(spark)
    air = _rows(taxi.airport_share(t), "service", "airport_trip", "trips", "share")
    assert air == [("yellow", False, 1, 0.3333), ("yellow", True, 2, 0.6667)]
    shared = _rows(taxi.shared_share(t), "service", "shared_trip", "trips")
    assert shared == [("fhv", False, 1), ("fhv", True, 1), ("hvfhs", False, 1), ("hvfhs", True, 2)]
    prov = _rows(taxi.provider_share(t), "provider", "trips", "share")
    assert prov == [("HV0009", 1, 0.3333), ("Lyft", 1, 0.3333), ("Uber", 1, 0.3333)]


def test_top_k_ties_and_fallback(spark):
    df = spark.createDataFrame(
        [("a", 2024, 1, 5), ("a", 2024, 2, 5), ("a", 2024, 3, 4), ("a", 2023, 4, 9), ("b", 2024, 9, 1), ("b", 2023, 8, 7), ("b", 2023, 7, 6)],
        "service string, year int, pu int, trips long",
    )
    top = common.top_k_per_group(df, "service", [F.col("trips").desc(), F.col("pu")], 2)
    assert _rows(top, "service", "pu") == [("a", 1), ("a", 4), ("b", 7), ("b", 8)]
    fb = common.top_k_with_fallback(df, "service", "year", [F.col("trips").desc(), F.col("pu")], 2)
    # a: latest year has 3 rows >= min(2, 4) -> latest only; b: 1 row < min(2, 3) -> all years
    assert sorted(_rows(fb, "service", "pu")) == [("a", 1), ("a", 2), ("b", 7), ("b", 8)]


def test_zone_lookup_unknown(spark):
    t = _trip_groups(spark)
    zones = spark.createDataFrame([(132, "Queens", "JFK Airport")], "LocationID int, Borough string, Zone string")
    b = _rows(taxi.borough_share(t, zones), "service", "Borough", "trips")
    assert ("yellow", "Queens", 2) in b and ("yellow", "Unknown", 1) in b
    z = taxi.top_pickup_zones(t, zones, k=1).collect()
    assert {(r.service, r.PULocationID, r.Zone) for r in z} >= {("yellow", 132, "JFK Airport")}


def test_traffic_cleaning(spark):
    raw = spark.createDataFrame(
        [
            ("bronx ", 2024, 2, 30, 1, 10, "A", "B", "C", "nb"),
            ("BRONX", 2024, 2, 29, 1, -5, "A", "B", "C", "nb"),
            ("Bronx", 2024, 2, 29, 2, 7, " ", "", None, None),
            (None, 2024, 2, 29, 2, 7, "A", "B", "C", "nb"),
            ("queens", 2024, 3, 2, 3, 3, "A", "B", "C", " sb "),
        ],
        "Boro string, Yr int, M int, D int, HH int, Vol int, street string, fromSt string, toSt string, Direction string",
    )
    c = traffic.clean_counts(raw).collect()
    assert [(r.Boro, r.Vol, r.Direction, r.corridor, r.is_weekend) for r in c] == [
        ("Bronx", 7, "UNK", "UNK", False),
        ("Queens", 3, "SB", "A | B | C | SB", True),
    ]


def test_first_non_null_skips_nulls(spark):
    df = spark.createDataFrame(
        [("r1", 1, "s", "e", None, 1.0, 2.0, "E", 1.0, 2.0, 5.0), ("r2", 2, "s", "e", "Name", 3.0, 4.0, None, 5.0, 6.0, 7.0)],
        "ride_id string, ride_key int, start_station_id string, end_station_id string, start_station_name string, start_lat double, "
        "start_lng double, end_station_name string, end_lat double, end_lng double, duration_min double",
    )
    f = bikes.station_flows(df).collect()[0]
    assert (f.start_station_name, f.start_lat, f.end_station_name, f.trip_count, f.avg_duration_min) == ("Name", 1.0, "E", 2, 6.0)


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_systematic_sample_matches_brute_force(spark, slices):
    rnd = random.Random(7)
    rows = [(i, "hot" if i % 3 else rnd.choice(["a", "b"]), rnd.randint(0, 50)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, t int")
    got = sorted(r.id for r in sampling.systematic_sample(df, ["g"], ["t", "id"], 100, num_slices=slices).collect())
    expect = []
    for g in {r[1] for r in rows}:
        grp = sorted((r for r in rows if r[1] == g), key=lambda r: (r[2], r[0]))
        step = max(1, math.ceil(len(grp) / 100))
        expect += [r[0] for i, r in enumerate(grp) if len(grp) <= 100 or i % step == 0]
    assert got == sorted(expect)


def test_point_in_polygon_boundaries(spark):
    polys = spark.createDataFrame(
        [(1, [{"x": 0, "y": 0}, {"x": 10, "y": 0}, {"x": 10, "y": 10}, {"x": 0, "y": 10}, {"x": 0, "y": 0}]),
         (2, [{"x": 20, "y": 0}, {"x": 30, "y": 0}, {"x": 30, "y": 10}, {"x": 25, "y": 5}, {"x": 20, "y": 10}, {"x": 20, "y": 0}])],
        "poly_id int, ring array<struct<x:long,y:long>>",
    )
    pts = spark.createDataFrame(
        [(1, 5, 5), (2, 10, 5), (3, 0, 0), (4, 11, 5), (5, 25, 5), (6, 25, 8), (7, 22, 3), (8, 15, 15), (9, 10, 10)],
        "id int, x long, y long",
    )
    got = sorted(r.id for r in polygons.points_in_polygons(pts, polys, cell=4).collect())
    assert got == [1, 2, 3, 5, 7, 9]  # edge, vertex and the notch tip count as inside; (25, 8) is in the notch


@pytest.mark.parametrize("cell", [1, 3, 7, 1000])
def test_point_in_polygon_random_rings(spark, cell):
    """Every point of a square against random rings (also self-crossing, repeated, degenerate and empty ones)."""
    rnd = random.Random(cell)
    rings = []
    for _ in range(12):
        ox, oy = rnd.randint(-20, 20), rnd.randint(-20, 20)
        ring = [(ox + rnd.randint(0, 14), oy + rnd.randint(0, 14)) for _ in range(rnd.randint(3, 9))]
        rings.append(ring + ring[:1])
    rings += [rings[0], [], [(3, 3)], [(1, 1), (4, 1), (1, 1)], [(-9, -9), (-9, -9)]]
    polys = spark.createDataFrame(
        [(i % 3, [{"x": x, "y": y} for x, y in ring]) for i, ring in enumerate(rings)], "poly_id int, ring array<struct<x:long,y:long>>"
    )

    def inside(px, py, ring):
        hits = 0
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (x2 - x1) * (py - y1) == (y2 - y1) * (px - x1) and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
                return True
            if (y1 > py) != (y2 > py):
                hits += (px - x1) * abs(y2 - y1) < (x2 - x1) * (py - y1) * (1 if y2 > y1 else -1)
        return hits % 2 == 1

    grid = [(x * 1000 + y, x, y) for x in range(-24, 40) for y in range(-24, 40)]
    pts = spark.createDataFrame(grid + grid[:3], "id int, x long, y long")
    got = sorted(r.id for r in polygons.points_in_polygons(pts, polys, cell=cell).collect())
    want = sorted(i for i, x, y in grid + grid[:3] if any(inside(x, y, ring) for ring in rings))
    assert got == want
    assert polygons.points_in_polygons(pts, polys.limit(0), cell=cell).collect() == []


@pytest.mark.parametrize("leaf_size", [16, 4, 1])
def test_nearest_matches_brute_force_with_hot_cell(spark, leaf_size):
    rnd = random.Random(3)
    stops = [(i, rnd.randint(0, 30), rnd.randint(0, 30)) for i in range(200)] + [(1000 + i, rnd.randint(900, 999), rnd.randint(900, 999)) for i in range(5)]
    pts = [(i, rnd.randint(0, 999), rnd.randint(0, 999)) for i in range(300)]
    sdf = spark.createDataFrame(stops, "sid long, x long, y long")
    pdf = spark.createDataFrame(pts, "pid long, x long, y long")
    got = {r.pid: (r.sid, r.dist2) for r in leaf_index.nearest(pdf, sdf, "pid", "sid", leaf_size=leaf_size).collect()}
    for pid, x, y in pts:
        best = min(((x - sx) ** 2 + (y - sy) ** 2, sid) for sid, sx, sy in stops)
        assert got[pid] == (best[1], best[0])


def test_within_distance_matches_brute_force(spark):
    rnd = random.Random(5)
    stops = [(rnd.randint(0, 200), rnd.randint(0, 200)) for _ in range(40)]
    pts = [(i, rnd.randint(0, 200), rnd.randint(0, 200)) for i in range(500)]
    sdf = spark.createDataFrame(stops, "x long, y long")
    pdf = spark.createDataFrame(pts, "pid long, x long, y long")
    got = sorted(r.pid for r in leaf_index.within_distance(pdf, sdf, 15, center=(100, 100), center_radius=30).collect())
    expect = sorted(
        p for p, x, y in pts
        if (x - 100) ** 2 + (y - 100) ** 2 <= 900 or any((x - a) ** 2 + (y - b) ** 2 <= 225 for a, b in stops)
    )
    assert got == expect


def _dijkstra(edges, src):
    adj = {}
    for u, v, w in edges:
        adj.setdefault(u, []).append((v, w))
    dist, heap = {src: 0.0}, [(0.0, src)]
    while heap:
        d, u = heapq.heappop(heap)
        if d > dist.get(u, math.inf):
            continue
        for v, w in adj.get(u, []):
            if d + w < dist.get(v, math.inf):
                dist[v] = d + w
                heapq.heappush(heap, (d + w, v))
    return dist


def test_bounded_costs_match_dijkstra(spark):
    rnd = random.Random(11)
    edges = [(rnd.randrange(40), rnd.randrange(40), float(rnd.randint(1, 9))) for _ in range(120)] + [(40, 41, 1.0)]
    edf = spark.createDataFrame(edges, "u long, v long, w double")
    src = spark.createDataFrame([(0,), (5,)], "source long")
    got = {(r.source, r.node): r.cost for r in network.bounded_costs(src, edf, "w", cutoff=12.0).collect()}
    expect = {}
    for s in (0, 5):
        for n, d in _dijkstra(edges, s).items():
            if d <= 12.0:
                expect[(s, n)] = d
    assert got == expect
    assert not any(n in (40, 41) for _, n in got)  # unreachable component


def _graph(rnd, n, m, low=1):
    return [(rnd.randrange(n), rnd.randrange(n), float(rnd.randint(low, 9))) for _ in range(m)]


@pytest.mark.parametrize(("band", "hops"), [(None, 2), (3.0, 2), (1.0, 1), (1e9, 3)])
def test_bands_do_not_change_costs(spark, band, hops):
    """Two keys with graphs of their own, weights of zero, a source outside the graph."""
    rnd = random.Random(12)
    graphs = {k: _graph(rnd, 30, 70, low=0) for k in ("a", "b")}
    edf = spark.createDataFrame([(k, *e) for k, es in graphs.items() for e in es], "mode string, u long, v long, w double")
    src = spark.createDataFrame([("a", 0), ("b", 3), ("b", 99), ("b", 3)], "mode string, source long")
    got = paths.bounded_costs(src, edf, "w", cutoff=11.0, keys=["mode"], band=band, hops=hops).collect()
    want = {(k, s, n): d for k, s in (("a", 0), ("b", 3), ("b", 99)) for n, d in _dijkstra(graphs[k], s).items() if d <= 11.0}
    assert {(r.mode, r.source, r.node): r.cost for r in got} == want and len(got) == len(want)


def test_search_without_edges(spark):
    edf = spark.createDataFrame([], "u long, v long, w double")
    src = spark.createDataFrame([(1,)], "source long")
    assert [tuple(r) for r in paths.bounded_costs(src, edf, "w").collect()] == [(1, 1, 0.0)]
    assert paths.bounded_costs(src.limit(0), edf, "w").collect() == []


def test_round_moves_no_edge_and_no_settled_row(spark):
    """With broadcast off no exchange lies above the edge scan or the scan of the log."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edf = spark.createDataFrame(_graph(random.Random(13), 50, 200), "u long, v long, w double")
        arcs = paths.BucketedTable(spark, "arcs", ["u"]).write(paths.cheapest(edf, "w"))
        log = paths.BucketedTable(spark, "costs", ["source", "node"]).write(
            spark.createDataFrame([(1, 1, 0.0, True, 0)], "source long, node long, cost double, todo boolean, round int")
        )
        cands = paths.round_candidates(log.read(), arcs.read(), ["source", "node"], 9.0, None, 2)
        df = paths.improved(cands, log.read(), ["source", "node"])
        lines = [ln for ln in df._jdf.queryExecution().executedPlan().toString().split("\n") if ln.strip()]
        depth = lambda ln: len(ln) - len(ln.lstrip(" :+-*()0123456789"))
        moved = []
        for i in (i for i, ln in enumerate(lines) if "FileScan" in ln):
            at, above = depth(lines[i]), []
            for ln in reversed(lines[:i]):
                if depth(ln) < at:
                    at = depth(ln)
                    above.append(ln)
                if "Join" in ln and above and above[-1] == ln:
                    break
            kind = "edges" if re.search(r"\bw#", lines[i]) else "log"
            moved.append((kind, any("Exchange" in ln for ln in above)))
        # the edges of every step and the known rows reach their join without an exchange; the frontier is dealt out
        assert moved.count(("edges", False)) == 3 and ("edges", True) not in moved, moved
        assert moved.count(("log", False)) >= 1, moved
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_goal_directed_paths(spark):
    """Every pair's path against all shortest paths; fewer states than a full search; unreachable pairs have none."""
    rnd = random.Random(14)
    side = 12
    at = lambda x, y: x * side + y
    edges = []
    for x in range(side):
        for y in range(side):
            for a, b in ((x + 1, y), (x, y + 1), (x - 1, y), (x, y - 1)):
                if 0 <= a < side and 0 <= b < side:
                    edges.append((at(x, y), at(a, b), float(rnd.randint(2, 6))))
    edges += [(a, b, w + 1) for a, b, w in edges[:40]] + [(500, 501, 1.0)]
    nodes = [(at(x, y), x * 10, y * 10) for x in range(side) for y in range(side)] + [(500, 0, 0), (501, 5, 5)]
    ndf = spark.createDataFrame(nodes, "node_id long, x long, y long")
    edf = spark.createDataFrame(edges, "u long, v long, length double")
    pairs = [(0, 0, at(2, 2)), (1, at(11, 11), at(8, 9)), (2, 0, at(1, 3)), (3, 500, 0), (4, 0, 501), (5, 7, 7)]
    pdf = spark.createDataFrame(pairs, "pair_id long, start_node long, end_node long")
    goals = paths.Goals(
        pdf.select(F.col("start_node").alias("source"), F.col("end_node").alias("target")), paths.landmark_bounds(ndf, edf, "length")
    )
    costs = paths.bounded_costs(goals.targets.select("source").distinct(), edf, "length", goals=goals, band=4.0, with_hops=True).checkpoint()
    assert costs.filter("source = 0").count() < 80  # of 144
    w = {}
    for u, v, ln in edges:
        w[(u, v)] = min(w.get((u, v), math.inf), ln)
    got = {}
    for r in paths.shortest_paths(pdf, costs, edf, "length").orderBy("pair_id", "hops").collect():
        got.setdefault(r.pair_id, []).append(r.node)
    assert set(got) == {0, 1, 2, 5} and got[5] == [7]
    for k, s, t in pairs:
        if k in got:
            assert got[k][0] == s and got[k][-1] == t
            assert sum(w[e] for e in zip(got[k], got[k][1:])) == _dijkstra(edges, s)[t]


def test_one_service_falls_back_to_all_years(spark):
    from citybeat.plans.catalog import queries

    years = {}
    for r in queries()["top_items_with_fallback"](spark, "/root/testdata/sf0.01").collect():
        years.setdefault(r.service, set()).add(r.year)
    assert years["A"] == years["N"] == {2000} and len(years["R"]) > 1


def test_route_groups(spark):
    """Chains, a hot segment, a repeated segment and routes of one point, against union-find."""
    rnd = random.Random(31)
    routes = {r: [rnd.randrange(60) for _ in range(rnd.randint(1, 4))] for r in range(60)}
    routes |= {100 + i: [200 + i, 201 + i, 202 + i] for i in range(40)}  # each shares a segment with the next
    routes |= {300 + i: [900, 901, 900] for i in range(30)}
    routes[400] = [950, 951, 950]  # a segment twice in one route only
    rows = [(r, i, n / 100.0, 0.0) for r, ns in routes.items() for i, n in enumerate(ns)]
    df = spark.createDataFrame(rows, "route_id long, seq int, lng double, lat double")
    parent = {r: r for r in routes}

    def top(r):
        while parent[r] != r:
            r = parent[r]
        return r

    by_seg = {}
    for r, ns in routes.items():
        for a, b in zip(ns, ns[1:]):
            by_seg.setdefault((min(a, b), max(a, b)), set()).add(r)
    for members in by_seg.values():
        for r in members:
            a, b = sorted((top(min(members)), top(r)))
            parent[b] = a
    links = {(min(m), r) for m in by_seg.values() for r in m if r != min(m)}
    want = {}
    for r in routes:
        own = [x for x in routes if top(x) == top(r)]
        want[r] = (min(own), len(own), sum(top(a) == top(r) for a, _ in links))
    got = {r.route_id: (r.group_id, r.group_size, r.group_links) for r in groups.route_groups(df).collect()}
    assert got == want and got[400] == (400, 1, 0) and got[139] == (100, 40, 39)
    shared = groups.shared_segments(df).collect()
    assert sorted((r.first_route, r.last_route, r.n_routes) for r in shared) == sorted(
        (min(m), max(m), len(m)) for m in by_seg.values() if len(m) > 1
    )


def test_outlines_enclose_their_cells(spark):
    """Blobs with holes, corner contacts and single cells: areas add up, every outline is its cells' boundary."""
    import json

    rnd = random.Random(21)
    groups = {1: {(0, 0)}, 2: {(0, 0), (1, 1)}, 3: {(x, y) for x in range(3) for y in range(3)} - {(1, 1)}, 4: {(-5, -7), (-5, -6)}}
    groups[5] = {(x, 0) for x in range(70)}
    for g in range(6, 12):
        groups[g] = {(rnd.randrange(-6, 6), rnd.randrange(-6, 6)) for _ in range(rnd.randint(20, 110))}
    df = spark.createDataFrame([(g, x, y) for g, cs in groups.items() for x, y in cs], "g int, cx long, cy long")
    rows = outline.outlines(df, ["g"], 10).collect()
    for g, cells in groups.items():
        own = [r for r in rows if r.g == g]
        assert sum(r.area_m2 for r in own) == len(cells) * 100
        inside = lambda p, ring: sum(
            (a[1] > p[1]) != (b[1] > p[1]) and p[0] < a[0] for a, b in zip(ring, ring[1:])
        )
        rings = [json.loads(r.outline) for r in own]
        for r, ring in zip(own, rings):
            assert ring[0] == ring[-1] and r.hole == (r.area_m2 < 0)
            assert all((a[0] == b[0]) != (a[1] == b[1]) for a, b in zip(ring, ring[1:]))
            assert sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:])) == 2 * r.area_m2
            assert sum(abs(a[0] - b[0]) + abs(a[1] - b[1]) for a, b in zip(ring, ring[1:])) == 10 * r.edges
        for x in range(-8, 72 if g == 5 else 8):
            for y in range(-8, 8):
                crossings = sum(inside((x * 10 + 5, y * 10 + 5), ring) for ring in rings)
                assert (crossings % 2 == 1) == ((x, y) in cells)
    assert len([r for r in rows if r.g == 2]) == 2 and len([r for r in rows if r.g == 3]) == 2
    assert outline.outlines(df.limit(0), ["g"], 10).collect() == []


def test_reports_stop_at_blank_and_fill_days(spark):
    cells = [
        ("f_q2-2023.xlsx", "Sheet A", 0, 0, "VIO TYPE: Plates"),
        ("f_q2-2023.xlsx", "Sheet A", 1, 0, "MONTH: April"),
        ("f_q2-2023.xlsx", "Sheet A", 2, 0, "Day Of Week - Rejects"),
        ("f_q2-2023.xlsx", "Sheet A", 3, 1, "mon"),
        ("f_q2-2023.xlsx", "Sheet A", 3, 3, "TUE"),
        ("f_q2-2023.xlsx", "Sheet A", 4, 0, "Reject Reason"),
        ("f_q2-2023.xlsx", "Sheet A", 4, 1, "AM"),
        ("f_q2-2023.xlsx", "Sheet A", 4, 2, "PM"),
        ("f_q2-2023.xlsx", "Sheet A", 4, 3, "AM"),
        ("f_q2-2023.xlsx", "Sheet A", 5, 0, "Glare"),
        ("f_q2-2023.xlsx", "Sheet A", 5, 1, "3"),
        ("f_q2-2023.xlsx", "Sheet A", 5, 2, "4"),
        ("f_q2-2023.xlsx", "Sheet A", 5, 3, "5"),
        ("f_q2-2023.xlsx", "Sheet A", 6, 0, "reject reason"),
        ("f_q2-2023.xlsx", "Sheet A", 7, 0, "Dark"),
        ("f_q2-2023.xlsx", "Sheet A", 7, 2, "1"),
        ("f_q2-2023.xlsx", "Sheet A", 9, 0, "After blank"),
        ("f_q2-2023.xlsx", "Sheet A", 9, 1, "99"),
        ("f_q2-2023.xlsx", "Sheet A", 10, 0, "Borough - Rejects"),
        ("f_q2-2023.xlsx", "Sheet A", 11, 0, "Reject Reason"),
        ("f_q2-2023.xlsx", "Sheet A", 11, 1, "STATEN ISLAND"),
        ("f_q2-2023.xlsx", "Sheet A", 12, 0, "Glare"),
        ("f_q2-2023.xlsx", "Sheet A", 12, 1, "8"),
        ("f_q2-2023.xlsx", "Reject Category 1", 0, 0, "Borough - Rejects"),
        ("other.xlsx", "S", 0, 0, "Community Board - Rejects"),
        ("other.xlsx", "S", 1, 0, "Reject Reason"),
        ("other.xlsx", "S", 1, 1, "BX   01"),
        ("other.xlsx", "S", 2, 0, "Glare"),
        ("other.xlsx", "S", 2, 1, "2"),
    ]
    df = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    out = _rows(reports.tidy_reports(df), "source_file", "quarter", "month", "violation_type", "section", "reject_reason", "day", "time_window", "borough", "community_board", "count")
    assert out == sorted([
        ("f_q2-2023.xlsx", "Q2-2023", "April", "Plates", "day_of_week", "Glare", "MON", "AM", "", "", 3),
        ("f_q2-2023.xlsx", "Q2-2023", "April", "Plates", "day_of_week", "Glare", "MON", "PM", "", "", 4),
        ("f_q2-2023.xlsx", "Q2-2023", "April", "Plates", "day_of_week", "Glare", "TUE", "AM", "", "", 5),
        ("f_q2-2023.xlsx", "Q2-2023", "April", "Plates", "day_of_week", "Dark", "MON", "PM", "", "", 1),
        ("f_q2-2023.xlsx", "Q2-2023", "April", "Plates", "borough", "Glare", "", "", "Staten Island", "", 8),
        ("other.xlsx", "UNKNOWN", "Unknown", "Unknown", "community_board", "Glare", "", "", "", "BX 01", 2),
    ])


def test_geojson_points_and_sink(spark, tmp_path):
    import json

    from citybeat.sources.files import read_geojson_points, to_geojson_features, write_geojson_seq

    fc = {"type": "FeatureCollection", "features": [
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": [-73.9, 40.7]}, "properties": {"name": "a", "type": "shelter"}},
        {"type": "Feature", "geometry": {"type": "Point", "coordinates": []}, "properties": {"name": "b", "type": "shelter"}},
    ]}
    p = tmp_path / "pts.geojson"
    p.write_text(json.dumps(fc))
    pts = read_geojson_points(spark, str(p)).collect()
    assert [(r.lng, r.lat, r.properties["name"]) for r in pts] == [(-73.9, 40.7, "a")]
    feats = to_geojson_features(read_geojson_points(spark, str(p)).select("lng", "lat", "properties.name"), "Point", F.array("lng", "lat"), ["name"])
    out = tmp_path / "seq"
    write_geojson_seq(feats, str(out))
    lines = [json.loads(x) for f in out.glob("part-*") for x in f.read_text().splitlines()]
    assert lines == [{"type": "Feature", "geometry": {"type": "Point", "coordinates": [-73.9, 40.7]}, "properties": {"name": "a"}}]


def test_whole_or_parts(spark, tmp_path):
    from citybeat.sources.files import read_csv, resolve_whole_or_parts

    (tmp_path / "t_part2.csv").write_text("a,b\n3,x\n")
    (tmp_path / "t_part1.csv").write_text("a,b\n1,y\n2,z\n")
    paths = resolve_whole_or_parts(spark, str(tmp_path / "t.csv"), [str(tmp_path / "t_part*.csv")])
    assert [p.rsplit("/", 1)[1] for p in paths] == ["t_part1.csv", "t_part2.csv"]
    assert sorted(r.a for r in read_csv(spark, paths, "a long, b string").collect()) == [1, 2, 3]
    (tmp_path / "t.csv").write_text("a,b\n9,w\n")
    assert resolve_whole_or_parts(spark, str(tmp_path / "t.csv"), [str(tmp_path / "t_part*.csv")])[0].endswith("t.csv")


def test_parts_manifest_round_trip(spark, tmp_path):
    from citybeat.sources.files import read_csv, read_parts_manifest, resolve_whole_or_parts, write_csv_parts, write_parts_manifest

    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id"))
    parts = str(tmp_path / "out_parts")
    write_csv_parts(df, parts, 10, ["g"])
    write_parts_manifest(spark, parts, "out.csv", str(tmp_path / "out.parts.json"))
    base, names = read_parts_manifest(spark, str(tmp_path / "out.parts.json"))
    assert base == "out.csv" and names == sorted(names) and all(n.startswith("g=") for n in names) and len(names) >= 10
    paths = resolve_whole_or_parts(spark, str(tmp_path / "out.csv"), manifest=str(tmp_path / "out.parts.json"), parts_dir=parts)
    assert read_csv(spark, paths, "id long").count() == 100


def test_year_folder_discovery_and_schema_groups(spark, tmp_path):
    """S1 + S2: files under root/<year>/<service>/ with two schemas are read
    as two groups, each resolving its own aliases, then unioned."""
    from citybeat.sources.trips import read_file_groups, year_partition_paths

    old = spark.createDataFrame([(dt.datetime(2022, 5, 1, 8), 2.5)], "Pickup_datetime timestamp, trip_miles double")
    new = spark.createDataFrame(
        [(dt.datetime(2023, 6, 1, 9), 1.5, 7), (dt.datetime(2023, 6, 2, 9), 0.5, 8)],
        "tpep_pickup_datetime timestamp, trip_distance double, PULocationID int",
    )
    old.write.parquet(str(tmp_path / "2022" / "yellow_taxi" / "a.parquet"))
    new.write.parquet(str(tmp_path / "2023" / "yellow_taxi" / "b.parquet"))
    paths = year_partition_paths(str(tmp_path), [2021, 2022, 2023], "yellow_taxi")
    groups = read_file_groups(spark, paths)
    assert len(groups) == 2
    fields = ["pickup_datetime", "trip_distance", "PULocationID"]
    t = union_groups([normalize_trips(g, "yellow", "yellow", fields, 2022, 2023) for g in groups])
    assert sorted((r.year, r.trip_distance, r.has_PULocationID) for r in t.collect()) == [
        (2022, 2.5, False), (2023, 0.5, True), (2023, 1.5, True),
    ]


def test_chart_ready_filter(spark):
    df = spark.createDataFrame(
        [("A", 2000, 1, 5.0), ("A", 2000, 13, 5.0), ("Z", 2000, 1, 5.0), ("A", 1990, 1, 5.0), ("A", 2000, 2, float("nan")), ("A", 2000, 3, None)],
        "service string, year int, month int, trips double",
    )
    assert [tuple(r) for r in taxi.chart_ready(df, ["A"], (1996, 2000), "trips").collect()] == [("A", 2000, 1, 5.0)]


def test_ridership_grid_zero_fill_and_shares(spark):
    from citybeat.operators import ridership

    rows = spark.createDataFrame(
        [("bus", 2020, 10.0), ("bus", 2020, 20.0), ("rail", 2020, 5.0), ("bus", 2021, 7.0), ("ferry", 2021, 0.0)],
        "mode string, year int, ridership double",
    )
    means = ridership.mode_year_means(rows)
    share = {(r.year, r.mode): (r.ridership, r.share) for r in ridership.mode_share(means).collect()}
    assert share[(2020, "ferry")] == (0.0, 0.0) and share[(2021, "rail")] == (0.0, 0.0)
    assert share[(2020, "bus")] == (15.0, 0.75) and share[(2021, "bus")] == (7.0, 1.0)
    stack = {(r.year, r.mode): (r.y0, r.y1) for r in ridership.stacked_pivot(means, ["rail", "bus"]).collect()}
    assert stack[(2020, "rail")] == (0.0, 5.0) and stack[(2020, "bus")] == (5.0, 20.0) and stack[(2021, "rail")] == (0.0, 0.0)
    latest = {r.mode: r.share for r in ridership.latest_year_share(means, ["bus", "rail"]).collect()}
    assert latest == {"bus": 1.0, "rail": 0.0}
    feat = sorted((r.mode, r.year, r.total, r.share) for r in ridership.featured_years(means).collect())
    assert feat == [("bus", 2020, 20.0, 0.75), ("bus", 2021, 7.0, 1.0), ("ferry", 2021, 7.0, 0.0), ("rail", 2020, 20.0, 0.25)]


def test_size_capped_parts(spark, tmp_path):
    from citybeat.sources.files import parts_manifest, write_csv_parts_by_size

    df = spark.range(20000).select(F.col("id"), F.concat(F.lit("row-"), F.col("id").cast("string")).alias("label"))
    out = str(tmp_path / "parts")
    cap = write_csv_parts_by_size(df.repartition(2), out, 0.05)
    sizes = [f.stat().st_size for f in (tmp_path / "parts").glob("part-*.csv")]
    assert cap > 0 and len(sizes) > 2
    assert max(sizes) <= 0.05 * 1024 * 1024 * 1.1 + 100  # header + rounding
    man = parts_manifest(spark, out, "id long, label string")
    assert man.agg(F.sum("rows")).first()[0] == 20000


def test_within_distance_dense_cluster_path(spark):
    rnd = random.Random(9)
    stops = [(rnd.randint(0, 20), rnd.randint(0, 20)) for _ in range(300)] + [(rnd.randint(0, 400), rnd.randint(0, 400)) for _ in range(30)]
    pts = [(i, rnd.randint(0, 400), rnd.randint(0, 400)) for i in range(400)] + [(1000 + i, rnd.randint(0, 40), rnd.randint(0, 40)) for i in range(100)]
    sdf = spark.createDataFrame(stops, "x long, y long")
    pdf = spark.createDataFrame(pts, "pid long, x long, y long")
    got = sorted(r.pid for r in leaf_index.within_distance(pdf, sdf, 12, center=(300, 300), center_radius=20, leaf_size=4).collect())
    expect = sorted(
        p for p, x, y in pts
        if (x - 300) ** 2 + (y - 300) ** 2 <= 400 or any((x - a) ** 2 + (y - b) ** 2 <= 144 for a, b in stops)
    )
    assert got == expect


def test_export_outputs(spark, tmp_path):
    from citybeat.plans.export import export_outputs

    paths = export_outputs(spark, "/root/testdata/sf0.001", str(tmp_path), ["trips_monthly", "airport_share"])
    assert [p.rsplit("/", 1)[1] for p in paths] == ["trips_monthly", "airport_share"]
    back = spark.read.option("header", True).csv(paths[1])
    assert set(back.columns) == {"service", "airport_trip", "trips", "share"} and back.count() > 0


def test_year_discovery_defaults_and_skips(spark, tmp_path):
    from citybeat.sources.trips import available_years, normalize_file_groups, read_file_groups, select_years, year_partition_paths

    a = spark.createDataFrame([(dt.datetime(2022, 5, 1, 8), 1.0)], "tpep_pickup_datetime timestamp, trip_distance double")
    b = spark.createDataFrame([(dt.datetime(2023, 6, 1, 9), 2.0)], "tpep_pickup_datetime timestamp, trip_distance double")
    c = spark.createDataFrame([(7, 3.0)], "vendor int, trip_distance double")  # no pickup column: skipped
    a.write.parquet(str(tmp_path / "2022" / "yellow_taxi" / "a.parquet"))
    b.write.parquet(str(tmp_path / "2023" / "yellow_taxi" / "b.parquet"))
    c.write.parquet(str(tmp_path / "2023" / "yellow_taxi" / "c.parquet"))
    years = available_years(spark, str(tmp_path))
    assert years == [2022, 2023] and select_years(years) == [2023]
    assert select_years(years, 2022) == [2022] and select_years(years, 2020, 2023) == [2022, 2023]
    groups = read_file_groups(spark, year_partition_paths(str(tmp_path), select_years(years), "yellow_taxi"))
    assert len(groups) == 2
    t = normalize_file_groups(groups, "yellow", "yellow", ["pickup_datetime", "trip_distance"], 2023, 2023)
    assert [(r.year, r.trip_distance) for r in t.collect()] == [(2023, 2.0)]
    assert len(read_file_groups(spark, year_partition_paths(str(tmp_path), [2021, 2022, 2023], "yellow_taxi"))) == 2


def test_report_header_outside_search_window_is_skipped(spark):
    cells = [("f.xlsx", "S", 0, 0, "Borough - Rejects")] + [("f.xlsx", "S", r, 0, f"note {r}") for r in range(1, 5)] + [
        ("f.xlsx", "S", 5, 0, "Reject Reason"),  # 5 rows below the title: beyond the 4-row window
        ("f.xlsx", "S", 5, 1, "BRONX"),
        ("f.xlsx", "S", 6, 0, "Glare"),
        ("f.xlsx", "S", 6, 1, "3"),
    ]
    df = spark.createDataFrame(cells, "file string, sheet string, row int, col int, value string")
    assert reports.tidy_reports(df).count() == 0


def test_latest_isochrones_largest_first(spark):
    centres = spark.createDataFrame([(1, 40.7, -74.0)], "id int, lat double, lng double")
    rings = spatial.ring_points(centres, {"walking": 4.8, "cycling": 15.0}, [5, 40, 10, 60])
    rows = network.latest_isochrones(rings, "cycling").collect()
    assert [r.minutes for r in rows][:: 97] == [40, 10, 5]
    assert {r.mode for r in rows} == {"cycling"} and len(rows) == 3 * 97
    first = [r for r in rows if r.minutes == 40]
    assert first[0].ring_lng == first[-1].ring_lng and first[0].ring_lat == first[-1].ring_lat  # closed ring


def test_category_grid_zero_fill_and_duplicates(spark):
    from citybeat.operators.grid import category_grid

    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "y", 5), ("b", "zz", 9)], "s string, c string, n long")
    got = sorted(tuple(r) for r in category_grid(df, "s", "c", "n", ["x", "y"]).collect())
    assert got == [("a", "x", 3), ("a", "y", 0), ("b", "x", 0), ("b", "y", 5)]


def test_dates_numbers_and_titles_as_wide_as_the_inputs(spark):
    from citybeat.functions.datetime import epoch_to_timestamp, parse_mixed_timestamp
    from citybeat.functions.numeric import to_double
    from citybeat.functions.text import normalize_borough

    rows = [("1/2/2024 3:04", "2024-01-02 03:04:00"), ("01/02/2024 03:04:05 PM", "2024-01-02 15:04:05"),
            ("1/2/2024 12:00 AM", "2024-01-02 00:00:00"), ("2024-1-2 3:04:05", "2024-01-02 03:04:05"), ("NaT", None)]
    got = spark.createDataFrame(rows, "s string, t string").select(parse_mixed_timestamp("s").cast("string").alias("g"), "t").collect()
    assert all(r.g == r.t for r in got)
    ns = [1_704_067_200_123_457_000 + i * 1_000_000_007 for i in range(200)] + [-5, 1_704_067_200, 1_704_067_200_123]
    back = spark.createDataFrame([(n,) for n in ns], "n long").select("n", F.unix_micros(epoch_to_timestamp("n", integral=True)).alias("u")).collect()
    assert all(r.u == (r.n // 1000 if abs(r.n) >= 10**17 else r.n * 1000 if abs(r.n) >= 10**11 else r.n * 10**6) for r in back)
    assert spark.createDataFrame([(float("nan"),)], "x double").select(to_double("x").alias("x")).first().x is None
    names = [(" bronx/QUEENS ", "Bronx/Queens"), ("o'hara-east 2nd", "O'Hara-East 2Nd"), ("", "")]
    assert all(r.g == r.w for r in spark.createDataFrame(names, "b string, w string").select(normalize_borough("b").alias("g"), "w").collect())


def test_mean_is_not_rounded(spark):
    from citybeat.operators.ridership import mode_year_means

    df = spark.createDataFrame([("a", 2000, 1.0), ("a", 2000, 2.0), ("a", 2000, 2.0)], "mode string, year int, ridership double")
    assert mode_year_means(df).first().ridership == pytest.approx(5 / 3, rel=1e-15)


def test_nearest_without_stops_keeps_every_point(spark):
    pts = spark.createDataFrame([(1, 0, 0), (2, 5, 5)], "pid long, x long, y long")
    got = leaf_index.nearest(pts, spark.createDataFrame([], "sid long, x long, y long"), "pid", "sid").collect()
    assert sorted((r.pid, r.sid, r.dist2) for r in got) == [(1, None, None), (2, None, None)]


def test_leaf_index_splits_crowded_cells_only(spark):
    rnd = random.Random(11)
    crowd = [(i, rnd.randint(0, 63), rnd.randint(0, 63)) for i in range(1500)]
    stops = crowd + [(5000 + i, rnd.randint(0, 1_000_000), rnd.randint(0, 1_000_000)) for i in range(60)] + [(9000, None, 4)]
    sdf = spark.createDataFrame(stops, "sid long, x long, y long")
    index = leaf_index.build_index(sdf, "sid")
    per_leaf = index.stops.groupBy("level", "cx", "cy").count().collect()
    assert max(r["count"] for r in per_leaf) <= leaf_index.LEAF_SIZE
    assert index.stops.count() == len({(x, y) for _, x, y in stops if x is not None})
    # one distinct position more than a leaf holds is enough to split: the far stops stay in shallow leaves
    assert min(r.level for r in per_leaf) <= 3 and max(r.level for r in per_leaf) >= 16
    pts = [(i, rnd.randint(-2000, 3000), rnd.randint(-2000, 3000)) for i in range(60)]
    pts += [(100 + i, rnd.randint(0, 1_000_000), rnd.randint(0, 1_000_000)) for i in range(60)] + [(300, 7, 7), (301, 7, 7), (302, None, 1)]
    pdf = spark.createDataFrame(pts, "pid long, x long, y long")
    got = {r.pid: (r.dist2, r.sid) for r in leaf_index.nearest(pdf, sdf, "pid", "sid").collect()}
    real = [s for s in stops if s[1] is not None]
    assert got == {p: min(((x - a) ** 2 + (y - b) ** 2, s) for s, a, b in real) for p, x, y in pts if x is not None}
    for radius in (0, 900, 150_000, 3_000_000):
        near = sorted(r.pid for r in leaf_index.within_distance(pdf, sdf, radius).collect())
        assert near == sorted(p for p, x, y in pts if x is not None and got[p][0] <= radius**2), radius
    none = sdf.limit(0)
    assert leaf_index.within_distance(pdf, none, 5).count() == 0
    assert [r.pid for r in leaf_index.within_distance(pdf, none, 5, center=(7, 7), center_radius=0).collect()] == [300, 301]
    one = spark.createDataFrame([(3, 5, 5), (2, 5, 5)], "sid long, x long, y long")
    assert {(r.sid, r.dist2) for r in leaf_index.nearest(pdf.filter("pid = 300"), one, "pid", "sid").collect()} == {(2, 8)}


def test_nearest_deals_idle_rows_by_position(spark):
    """Rows that ask for nothing at a level (found, or a cell that is no leaf) are not all under one key."""
    pts = spark.range(200).select(F.col("id").alias("pid"), (F.col("id") * 37 % 101).alias("x"), (F.col("id") * 53 % 97).alias("y"))
    stops = spark.range(60).select(F.col("id").alias("sid"), (F.col("id") * 41 % 89).alias("x"), (F.col("id") * 29 % 83).alias("y"))
    df = leaf_index.nearest(pts, stops, "pid", "sid", leaf_size=2)
    assert "~" in df._jdf.queryExecution().optimizedPlan().toString()
    brute = {
        p.pid: min(((p.x - s.x) ** 2 + (p.y - s.y) ** 2, s.sid) for s in stops.collect()) for p in pts.collect()
    }
    assert {r.pid: (r.dist2, r.sid) for r in df.collect()} == brute


def test_smallest_labels_merge_chains_and_stars(spark):
    """A chain under mixed ids, a star, a cycle and a link of a node to itself; links in either direction and twice."""
    rng = random.Random(5)
    ids = rng.sample(range(1000, 2000), 120)
    pairs = list(zip(ids, ids[1:])) + [(5, k) for k in range(10, 40)] + [(3001, 3002), (3002, 3003), (3003, 3001), (4000, 4000)]
    pairs += [(b, a) for a, b in pairs[::3]]
    links = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.label for r in groups.smallest_labels(links).collect()}
    want = {i: min(ids) for i in ids} | {k: 5 for k in [5, *range(10, 40)]} | {3001: 3001, 3002: 3001, 3003: 3001, 4000: 4000}
    assert got == want
    hooks = spark.createDataFrame([(k, k - 1) for k in range(1, 40)], "node long, label long")
    assert {r.label for r in groups._roots(hooks).collect()} == {0}
    assert groups.smallest_labels(links.limit(0)).count() == 0
