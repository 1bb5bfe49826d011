"""DuckDB oracle SQL for the spatial and network queries (brute force / unrolled)."""

from __future__ import annotations

from citybeat.constants import CIRCLE_MODES, MINUTES
from citybeat.plans.oracle_bikes import NATION_TRIPS

D = "CAST({} AS DOUBLE)"

PTS = """
pts AS (SELECT c_custkey, c_custkey * 37 % 1000 AS x, c_custkey * 91 % 1000 AS y FROM customer),
sp AS (SELECT s_suppkey, s_suppkey * 53 % 1000 AS x, s_suppkey * 29 % 1000 AS y FROM supplier)"""

ROUTE_POINTS = f"""{PTS.strip()},
rp AS (SELECT l_orderkey AS route_id, CAST(l_linenumber AS BIGINT) * 1000000000000 + l_suppkey AS seq,
              CAST(-74.05 AS DOUBLE) + sp.x / 10000.0 AS lng, CAST(40.6 AS DOUBLE) + sp.y / 10000.0 AS lat
       FROM lineitem JOIN sp ON l_suppkey = sp.s_suppkey)"""


def _key(lng: str, lat: str, digits: int) -> str:
    s = f"{10 ** digits}.0"
    return (
        f"(CAST(CAST(round_even({lng} * {s}, 0) AS BIGINT) AS VARCHAR) || ',' || "
        f"CAST(CAST(round_even({lat} * {s}, 0) AS BIGINT) AS VARCHAR))"
    )


# a zone's extent shrinks as zones are added, so that about a third of the plane stays covered
ZONE_SIZE = "CAST(floor(600000 / sqrt((SELECT count(*) FROM supplier))) AS BIGINT)"

PLACES = """
c_places AS (SELECT c_custkey, c_custkey * 7919 % 1000003 AS x, c_custkey * 104729 % 999983 AS y FROM customer),
s_places AS (SELECT s_suppkey, s_suppkey * 7907 % 1000003 AS x, s_suppkey * 104723 % 999983 AS y FROM supplier)"""


FEATURE_COLLECTION = f"""
WITH {PLACES.strip()}
SELECT c_custkey, c_mktsegment, 'Feature' AS kind, CAST(x AS DOUBLE) AS lng, CAST(y AS DOUBLE) AS lat
FROM c_places JOIN customer USING (c_custkey)
"""


GRAPH = """
n AS (SELECT max(s_suppkey) + 1 AS n FROM supplier),
ks AS (SELECT * FROM (VALUES (1, 0), (1, 1), (2, 0), (3, 0)) t(k, key)),
edges AS (
  SELECT s_suppkey AS u, (s_suppkey * 7 + k) % n.n AS v, key,
         CAST(200 + (s_suppkey * 31 + ((s_suppkey * 7 + k) % n.n) * 17) % 800 + key * 50 AS DOUBLE) AS length
  FROM supplier, ks, n),
nodes AS (SELECT s_suppkey AS node_id, (s_suppkey * 53 % 1000) * 20 AS x, (s_suppkey * 29 % 1000) * 20 AS y FROM supplier)"""


def _rings(mode_filter: str = "") -> str:
    modes = ", ".join(f"('{m}', CAST({s} AS DOUBLE))" for m, s in CIRCLE_MODES.items())
    mins = ", ".join(f"({m})" for m in MINUTES)
    return f"""
WITH {PTS.strip()},
c AS (SELECT s_suppkey, CAST(-74.05 AS DOUBLE) + x / 10000.0 AS lng, CAST(40.6 AS DOUBLE) + y / 10000.0 AS lat FROM sp),
m AS (SELECT * FROM (VALUES {modes}) t(mode, speed_kmh) {mode_filter}),
mi AS (SELECT * FROM (VALUES {mins}) t(minutes)),
ix AS (SELECT CAST(range AS INTEGER) AS i FROM range(0, 97)),
g AS (SELECT c.*, m.mode, mi.minutes, ix.i, m.speed_kmh * (mi.minutes / 60.0) AS dist_km FROM c, m, mi, ix),
t AS (SELECT *, dist_km / 6371.0 AS ang, radians(lat) AS lat1, radians(lng) AS lng1,
             (2 * pi()) * (CAST(i AS DOUBLE) / 96.0) AS b FROM g),
u AS (SELECT *, asin(sin(lat1) * cos(ang) + cos(lat1) * sin(ang) * cos(b)) AS lat2 FROM t)
SELECT s_suppkey, lng, lat, mode, minutes, round_even(dist_km * 100.0, 0) / 100.0 AS distance_km, i,
       round_even(degrees(lng1 + atan2(sin(b) * sin(ang) * cos(lat1), cos(ang) - sin(lat1) * sin(lat2))) * 1000000.0, 0) / 1000000.0 AS ring_lng,
       round_even(degrees(lat2) * 1000000.0, 0) / 1000000.0 AS ring_lat
FROM u
"""


def _bellman_ford(hops: int, cutoff: float) -> str:
    parts = ["r0 AS (SELECT s_suppkey AS source, s_suppkey AS node, CAST(0.0 AS DOUBLE) AS cost FROM supplier)"]
    for k in range(1, hops + 1):
        p = f"r{k - 1}"
        parts.append(
            f"r{k} AS (SELECT source, node, min(cost) AS cost FROM (SELECT * FROM {p} UNION ALL "
            f"SELECT {p}.source, w.v, {p}.cost + w.w FROM {p} JOIN w ON w.u = {p}.node WHERE {p}.cost + w.w <= {cutoff}) "
            f"GROUP BY source, node)"
        )
    return ",\n".join(parts)


def _paths(hops: int) -> str:
    """Shortest lengths from the route candidates' start nodes, equal lengths by fewest edges: the key is
    length * 1000 + edges (lengths are whole metres)."""
    parts = ["r0 AS (SELECT DISTINCT start_node AS source, start_node AS node, CAST(0 AS BIGINT) AS k FROM pairs)"]
    for i in range(1, hops + 1):
        p = f"r{i - 1}"
        parts.append(
            f"r{i} AS (SELECT source, node, min(k) AS k FROM (SELECT * FROM {p} UNION ALL "
            f"SELECT {p}.source, w.v, {p}.k + w.k FROM {p} JOIN w ON w.u = {p}.node) GROUP BY source, node)"
        )
    return ",\n".join(parts)


def _transit(hops: int, cutoff: float) -> str:
    parts = ["r0 AS (SELECT mode, source, source AS node, CAST(0.0 AS DOUBLE) AS cost FROM start)"]
    for k in range(1, hops + 1):
        p = f"r{k - 1}"
        parts.append(
            f"r{k} AS (SELECT mode, source, node, min(cost) AS cost FROM (SELECT * FROM {p} UNION ALL "
            f"SELECT {p}.mode, {p}.source, wm.v, {p}.cost + wm.w FROM {p} JOIN wm ON wm.mode = {p}.mode AND wm.u = {p}.node "
            f"WHERE {p}.cost + wm.w <= {cutoff}) GROUP BY mode, source, node)"
        )
    return ",\n".join(parts)


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    transit = f"""{PTS.strip()},
{GRAPH.strip()},
m AS (SELECT * FROM (VALUES ('bus', 400, 2000, CAST(18.0 AS DOUBLE)), ('subway', 600, 3000, CAST(30.0 AS DOUBLE))) t(mode, stop_r, start_r, kmh)),
allowed AS (
  SELECT m.mode, nodes.node_id, nodes.x, nodes.y FROM nodes, m
  WHERE (x - 10000) * (x - 10000) + (y - 10000) * (y - 10000) <= start_r * start_r
     OR EXISTS (SELECT 1 FROM pts p WHERE (p.x * 20 - nodes.x) * (p.x * 20 - nodes.x) + (p.y * 20 - nodes.y) * (p.y * 20 - nodes.y) <= m.stop_r * m.stop_r)),
start AS (SELECT mode, arg_min(node_id, ((x - 10000) * (x - 10000) + (y - 10000) * (y - 10000)) * 1000000 + node_id) AS source
          FROM allowed GROUP BY mode),
wm AS (SELECT m.mode, e.u, e.v, min(e.length / (m.kmh * 1000.0 / 3600.0)) AS w
       FROM edges e, m, allowed a, allowed b
       WHERE a.mode = m.mode AND b.mode = m.mode AND a.node_id = e.u AND b.node_id = e.v GROUP BY ALL),
{_transit(26, 600.0)},
tb AS (SELECT mode, source, node, cost, b.minutes FROM r26, (VALUES (5), (10)) b(minutes) WHERE cost <= b.minutes * 60.0)"""
    q["transit_bands"] = f"WITH {transit}\nSELECT mode, source, node, cost, minutes FROM tb\n"
    # every ring is walked from each of its edges; the walk from the smallest one counts
    q["isochrone_outlines"] = f"""WITH RECURSIVE {transit},
cells AS (
  SELECT DISTINCT mode, source, minutes, cx, cy
  FROM tb JOIN nodes ON nodes.node_id = tb.node, generate_series(-1000, 1000) gx(cx), generate_series(-1000, 1000) gy(cy)
  WHERE cx BETWEEN x // 100 - 3 AND x // 100 + 3 AND cy BETWEEN y // 100 - 3 AND y // 100 + 3
    AND ((2 * cx + 1) * 100 - 2 * x) * ((2 * cx + 1) * 100 - 2 * x) + ((2 * cy + 1) * 100 - 2 * y) * ((2 * cy + 1) * 100 - 2 * y) <= 160000),
sides AS (
  SELECT mode, source, minutes, cx AS x, cy AS y, 0 AS up, cx AS sx, cy AS sy, 0 AS dir FROM cells
  UNION ALL SELECT mode, source, minutes, cx + 1, cy, 1, cx + 1, cy, 1 FROM cells
  UNION ALL SELECT mode, source, minutes, cx, cy + 1, 0, cx + 1, cy + 1, 2 FROM cells
  UNION ALL SELECT mode, source, minutes, cx, cy, 1, cx, cy + 1, 3 FROM cells),
edge AS (
  SELECT mode, source, minutes, ((x + 1073741824) * 2147483648 + y + 1073741824) * 2 + up AS id, sx, sy, dir,
         sx + CASE dir WHEN 0 THEN 1 WHEN 2 THEN -1 ELSE 0 END AS ex, sy + CASE dir WHEN 1 THEN 1 WHEN 3 THEN -1 ELSE 0 END AS ey
  FROM sides QUALIFY count(*) OVER (PARTITION BY mode, source, minutes, x, y, up) = 1),
succ AS (
  SELECT a.mode, a.source, a.minutes, a.id, b.id AS nxt, b.dir <> a.dir AS corner FROM edge a
  JOIN edge b ON a.mode = b.mode AND a.source = b.source AND a.minutes = b.minutes AND b.sx = a.ex AND b.sy = a.ey
  QUALIFY row_number() OVER (PARTITION BY a.mode, a.source, a.minutes, a.id
                             ORDER BY CASE (b.dir - a.dir + 4) % 4 WHEN 1 THEN 0 WHEN 0 THEN 1 ELSE 2 END) = 1),
walk AS (
  SELECT mode, source, minutes, id AS head, id, CAST(0 AS BIGINT) AS place FROM edge
  UNION ALL
  SELECT w.mode, w.source, w.minutes, w.head, s.nxt, w.place + 1 FROM walk w
  JOIN succ s ON s.mode = w.mode AND s.source = w.source AND s.minutes = w.minutes AND s.id = w.id WHERE s.nxt > w.head),
heads AS (
  SELECT w.mode, w.source, w.minutes, w.head FROM walk w
  JOIN succ s ON s.mode = w.mode AND s.source = w.source AND s.minutes = w.minutes AND s.id = w.id AND s.nxt = w.head),
ring_pts AS (
  SELECT w.mode, w.source, w.minutes, w.head AS ring, w.place, e.sx, e.sy, e.ex, e.ey, b.corner
  FROM walk w JOIN heads USING (mode, source, minutes, head)
  JOIN edge e ON e.mode = w.mode AND e.source = w.source AND e.minutes = w.minutes AND e.id = w.id
  JOIN succ b ON b.mode = w.mode AND b.source = w.source AND b.minutes = w.minutes AND b.nxt = w.id),
rings AS (
  SELECT mode, source, minutes, ring, count(*) AS edges, CAST(sum(sx * ey - ex * sy) * 10000 // 2 AS BIGINT) AS area_m2,
         list('[' || CAST(sx * 100 AS VARCHAR) || ', ' || CAST(sy * 100 AS VARCHAR) || ']' ORDER BY place) FILTER (WHERE corner) AS c
  FROM ring_pts GROUP BY ALL)
SELECT mode, source, minutes, ring, area_m2 < 0 AS hole, edges, area_m2, '[' || array_to_string(list_append(c, c[1]), ', ') || ']' AS outline
FROM rings
"""
    q["points_in_polygons"] = f"""
WITH {PLACES.strip()},
r AS (SELECT s_suppkey AS ring, x AS ox, y AS oy, s_suppkey % 3 AS shape, {ZONE_SIZE} AS w FROM s_places),
v AS (
  SELECT ring, i, ox + w * CASE shape WHEN 0 THEN [0, 1000, 1000, 0, 0][i] WHEN 1 THEN [0, 1300, 700, 0][i] ELSE [0, 900, 900, 400, 400, 0, 0][i] END // 1000 AS x,
         oy + w * CASE shape WHEN 0 THEN [0, 0, 1000, 1000, 0][i] WHEN 1 THEN [0, 100, 1200, 0][i] ELSE [0, 0, 300, 300, 1100, 1100, 0][i] END // 1000 AS y
  FROM r, generate_series(1, 7) g(i) WHERE i <= CASE shape WHEN 0 THEN 5 WHEN 1 THEN 4 ELSE 7 END),
e AS (SELECT a.ring, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM v a JOIN v b ON a.ring = b.ring AND b.i = a.i + 1),
t AS (
  SELECT p.c_custkey, p.x, p.y, e.ring,
         bool_or((x2 - x1) * (p.y - y1) - (y2 - y1) * (p.x - x1) = 0
                 AND p.x BETWEEN least(x1, x2) AND greatest(x1, x2) AND p.y BETWEEN least(y1, y2) AND greatest(y1, y2)) AS on_edge,
         sum(CASE WHEN ((y1 > p.y) <> (y2 > p.y)) AND
                       (CASE WHEN y2 > y1 THEN (p.x - x1) * (y2 - y1) < (x2 - x1) * (p.y - y1)
                             ELSE (p.x - x1) * (y2 - y1) > (x2 - x1) * (p.y - y1) END) THEN 1 ELSE 0 END) AS hits
  FROM c_places p JOIN e ON p.y BETWEEN least(y1, y2) AND greatest(y1, y2) GROUP BY ALL)
SELECT DISTINCT c_custkey, x, y FROM t WHERE on_edge OR hits % 2 = 1
"""
    q["near_stops"] = f"""
WITH {PLACES.strip()}
SELECT c_custkey, x, y FROM c_places p
WHERE (x - 500000) * (x - 500000) + (y - 500000) * (y - 500000) <= 6400000000
   OR EXISTS (SELECT 1 FROM s_places s
              WHERE (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) <= ({ZONE_SIZE} // 2) * ({ZONE_SIZE} // 2))
"""
    q["nearest_stop"] = f"""
WITH {PLACES.strip()},
r AS (SELECT p.c_custkey, s.s_suppkey, (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) AS d2 FROM c_places p CROSS JOIN s_places s),
k AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d2, s_suppkey) AS rn FROM r)
SELECT c_custkey, s_suppkey, d2 AS dist2 FROM k WHERE rn = 1
"""
    q["route_overlap"] = f"""
WITH {ROUTE_POINTS.strip()},
k AS (SELECT route_id, seq, {_key('lng', 'lat', 5)} AS k FROM rp),
n AS (SELECT route_id, k, lead(k) OVER (PARTITION BY route_id ORDER BY seq) AS nk FROM k),
s AS (SELECT route_id, CASE WHEN k < nk THEN k || '|' || nk ELSE nk || '|' || k END AS seg FROM n WHERE nk IS NOT NULL),
ps AS (SELECT seg, min(route_id) <> max(route_id) AS shared FROM s GROUP BY seg)
SELECT route_id, count(*) AS n_segments, count(*) FILTER (WHERE shared) AS shared_segments,
       count(*) FILTER (WHERE shared) > 0 AS has_overlap
FROM s JOIN ps USING (seg) GROUP BY route_id
"""
    uses = f"""
WITH {ROUTE_POINTS.strip()},
k AS (SELECT route_id, seq, {_key('lng', 'lat', 5)} AS k FROM rp),
nx AS (SELECT route_id, k, lead(k) OVER (PARTITION BY route_id ORDER BY seq) AS nk FROM k),
u AS MATERIALIZED (SELECT DISTINCT route_id, CASE WHEN k < nk THEN k || '|' || nk ELSE nk || '|' || k END AS seg FROM nx WHERE nk IS NOT NULL)"""
    q["shared_segments"] = uses + """
SELECT seg, min(route_id) AS first_route, max(route_id) AS last_route, count(*) AS n_routes FROM u GROUP BY seg HAVING count(*) > 1
"""
    # labels spread from route to segment to route; as many rounds as the longest chain at these scales needs
    rounds = ",\n".join(
        f"g{i} AS MATERIALIZED (SELECT u.route_id, min(m.l) AS l FROM u JOIN "
        f"(SELECT seg, min(l) AS l FROM u JOIN g{i - 1} USING (route_id) GROUP BY seg) m USING (seg) GROUP BY u.route_id)"
        for i in range(1, 13)
    )
    q["route_groups"] = uses + f""",
g0 AS MATERIALIZED (SELECT DISTINCT route_id, route_id AS l FROM u),
{rounds},
links AS (SELECT DISTINCT f.a, u.route_id AS b FROM u JOIN (SELECT seg, min(route_id) AS a FROM u GROUP BY seg) f USING (seg) WHERE f.a < u.route_id),
nl AS (SELECT l, count(*) AS group_links FROM links JOIN g12 ON g12.route_id = links.a GROUP BY l),
sz AS (SELECT l, count(*) AS group_size FROM g12 GROUP BY l)
SELECT r.route_id, COALESCE(g12.l, r.route_id) AS group_id, COALESCE(sz.group_size, 1) AS group_size, COALESCE(nl.group_links, 0) AS group_links
FROM (SELECT DISTINCT route_id FROM rp) r LEFT JOIN g12 USING (route_id) LEFT JOIN sz USING (l) LEFT JOIN nl USING (l)
"""
    q["endpoint_roles"] = f"""
WITH {ROUTE_POINTS.strip()},
ends AS (SELECT route_id, arg_min(lng, seq) AS slng, arg_min(lat, seq) AS slat, arg_max(lng, seq) AS elng,
                arg_max(lat, seq) AS elat FROM rp GROUP BY route_id),
r AS (SELECT slng AS lng, slat AS lat, true AS is_start FROM ends UNION ALL SELECT elng, elat, false FROM ends)
SELECT {_key('lng', 'lat', 6)} AS key, min(lng) AS lng, min(lat) AS lat, bool_or(is_start) AS has_start,
       bool_or(NOT is_start) AS has_end
FROM r GROUP BY 1
"""
    q["station_rings"] = _rings()
    q["latest_isochrones"] = _rings("WHERE mode = 'cycling'")
    q["candidates_bbox"] = f"""
WITH {NATION_TRIPS.strip()},
f AS (SELECT start_station_id, end_station_id, arg_min(start_lat, ride_key) AS start_lat, arg_min(start_lng, ride_key) AS start_lng,
             arg_min(end_lat, ride_key) AS end_lat, arg_min(end_lng, ride_key) AS end_lng, count(ride_id) AS trip_count
      FROM nt GROUP BY ALL ORDER BY trip_count DESC, start_station_id, end_station_id LIMIT 50),
c AS (SELECT * FROM f WHERE start_station_id <> end_station_id ORDER BY trip_count DESC, start_station_id, end_station_id LIMIT 30)
SELECT min(least(start_lng, end_lng)) - CAST(0.02 AS DOUBLE) AS west, min(least(start_lat, end_lat)) - CAST(0.02 AS DOUBLE) AS south,
       max(greatest(start_lng, end_lng)) + CAST(0.02 AS DOUBLE) AS east, max(greatest(start_lat, end_lat)) + CAST(0.02 AS DOUBLE) AS north
FROM c
"""
    q["routes"] = f"""
WITH RECURSIVE {NATION_TRIPS.strip()},
f AS (SELECT start_station_id, end_station_id, arg_min(start_station_name, ride_key) AS start_station_name,
             arg_min(end_station_name, ride_key) AS end_station_name,
             arg_min(start_lat, ride_key) AS start_lat, arg_min(start_lng, ride_key) AS start_lng,
             arg_min(end_lat, ride_key) AS end_lat, arg_min(end_lng, ride_key) AS end_lng, count(ride_id) AS trip_count
      FROM nt GROUP BY ALL ORDER BY trip_count DESC, start_station_id, end_station_id LIMIT 50),
c AS (SELECT *, row_number() OVER (ORDER BY trip_count DESC, start_station_id, end_station_id) AS idx FROM f
      WHERE start_station_id <> end_station_id QUALIFY idx <= 30),
box AS (SELECT min(least(start_lng, end_lng)) - CAST(0.02 AS DOUBLE) AS west, min(least(start_lat, end_lat)) - CAST(0.02 AS DOUBLE) AS south,
               max(greatest(start_lng, end_lng)) + CAST(0.02 AS DOUBLE) AS east, max(greatest(start_lat, end_lat)) + CAST(0.02 AS DOUBLE) AS north FROM c),
n AS (SELECT max(s_suppkey) + 1 AS n FROM supplier),
nodes AS (SELECT s_suppkey AS node_id, (s_suppkey * 53 % 1000) * 20 AS x, (s_suppkey * 29 % 1000) * 20 AS y FROM supplier, box
          WHERE (s_suppkey * 53 % 1000) * 20 BETWEEN round_even((west + 74.1) * 1e5, 0) AND round_even((east + 74.1) * 1e5, 0)
            AND (s_suppkey * 29 % 1000) * 20 BETWEEN round_even((south - 40.5) * 1e5, 0) AND round_even((north - 40.5) * 1e5, 0)),
w AS (SELECT u, v, min(200 + (u * 31 + v * 17) % 800 + key * 50) * 1000 + 1 AS k
      FROM (SELECT s_suppkey AS u, (s_suppkey * 7 + k) % n.n AS v, key
            FROM supplier, (VALUES (1, 0), (1, 1), (2, 0), (3, 0)) t(k, key), n)
      WHERE u IN (SELECT node_id FROM nodes) AND v IN (SELECT node_id FROM nodes) GROUP BY u, v),
ends AS (SELECT idx, true AS is_start, CAST(round_even((start_lng + 74.1) * 1e5, 0) AS BIGINT) AS x, CAST(round_even((start_lat - 40.5) * 1e5, 0) AS BIGINT) AS y FROM c
         UNION ALL SELECT idx, false, CAST(round_even((end_lng + 74.1) * 1e5, 0) AS BIGINT), CAST(round_even((end_lat - 40.5) * 1e5, 0) AS BIGINT) FROM c),
snap AS (SELECT idx, is_start, node_id FROM ends, nodes
         QUALIFY row_number() OVER (PARTITION BY idx, is_start ORDER BY (ends.x - nodes.x) * (ends.x - nodes.x) + (ends.y - nodes.y) * (ends.y - nodes.y), node_id) = 1),
pairs AS (SELECT a.idx, a.node_id AS start_node, b.node_id AS end_node FROM snap a JOIN snap b ON a.idx = b.idx AND a.is_start AND NOT b.is_start),
{_paths(40)},
pred AS (SELECT t.source, t.node, min(w.u) AS back FROM r40 t JOIN w ON w.v = t.node JOIN r40 s ON s.source = t.source AND s.node = w.u AND s.k + w.k = t.k GROUP BY ALL),
walk AS (SELECT idx, source, node, CAST(0 AS BIGINT) AS step FROM pairs JOIN r40 ON source = start_node AND node = end_node
         UNION ALL SELECT walk.idx, walk.source, pred.back, walk.step + 1 FROM walk JOIN pred ON pred.source = walk.source AND pred.node = walk.node),
pts AS (SELECT idx, -step AS s, x, y FROM walk JOIN nodes ON node_id = node),
seg AS (SELECT *, lag(x) OVER p AS px, lag(y) OVER p AS py FROM pts WINDOW p AS (PARTITION BY idx ORDER BY s)),
kept AS (SELECT * FROM seg WHERE px IS NULL OR px <> x OR py <> y),
line AS (SELECT idx, list_sum(list(CASE WHEN px IS NULL THEN 0.0 ELSE sqrt(CAST(x - px AS DOUBLE) * (x - px) + CAST(y - py AS DOUBLE) * (y - py)) END ORDER BY s)) AS m,
                '[' || string_agg(printf('[%.6f, %.6f]', CAST(-74.1 AS DOUBLE) + x / 1e5, CAST(40.5 AS DOUBLE) + y / 1e5), ', ' ORDER BY s) || ']' AS coords
         FROM kept GROUP BY idx HAVING count(*) >= 2 ORDER BY idx LIMIT 10)
SELECT 'route_' || CAST(idx AS VARCHAR) AS route_id, start_station_id, start_station_name, end_station_id, end_station_name, trip_count,
       round_even(m * 10.0, 0) / 10.0 AS distance_m, coords
FROM line JOIN c USING (idx)
"""
    modes = "(SELECT * FROM (VALUES ('walking', CAST(4.8 AS DOUBLE)), ('cycling', CAST(15.0 AS DOUBLE)), ('driving', CAST(25.0 AS DOUBLE)), ('bus', CAST(18.0 AS DOUBLE)), ('subway', CAST(30.0 AS DOUBLE))) t(mode, speed))"
    q["edge_travel_time"] = f"""
WITH {GRAPH.strip()}
SELECT u, v, key, length, m.mode,
       CASE WHEN m.speed * 1000.0 / 3600.0 > 0 THEN length / (m.speed * 1000.0 / 3600.0) ELSE 0.0 END AS travel_time
FROM edges, {modes} m
"""
    q["induced_subgraph"] = f"""
WITH {GRAPH.strip()},
stops AS (SELECT (c_custkey * 37 % 1000) * 20 AS x, (c_custkey * 91 % 1000) * 20 AS y FROM customer),
ok AS (SELECT node_id FROM nodes p
       WHERE (x - 10000) * (x - 10000) + (y - 10000) * (y - 10000) <= 4000000
          OR EXISTS (SELECT 1 FROM stops s WHERE (p.x - s.x) * (p.x - s.x) + (p.y - s.y) * (p.y - s.y) <= 160000))
SELECT u, v, key, length FROM edges WHERE u IN (SELECT node_id FROM ok) AND v IN (SELECT node_id FROM ok)
"""
    bf = _bellman_ford(12, 600.0)
    reach = f"""
WITH {GRAPH.strip()},
w AS (SELECT u, v, min(length / (CAST(15.0 AS DOUBLE) * 1000.0 / 3600.0)) AS w FROM edges GROUP BY u, v),
{bf},
b AS (SELECT r12.*, m.minutes FROM r12, (VALUES (5), (10)) m(minutes) WHERE cost <= m.minutes * 60.0)"""
    q["reachable"] = reach + "\nSELECT source, node, cost, minutes FROM b\n"
    speeds = "(SELECT * FROM (VALUES ('walking', CAST(4.8 AS DOUBLE)), ('cycling', CAST(15.0 AS DOUBLE)), ('driving', CAST(25.0 AS DOUBLE)), ('bus', CAST(18.0 AS DOUBLE)), ('subway', CAST(30.0 AS DOUBLE))) t(mode, speed))"
    # 200 m an edge at least, so 5000 m (ten minutes at 30 km/h) allow at most 25 hops
    by_mode = f"""
WITH {GRAPH.strip()},
w AS (SELECT u, v, min(length) AS w FROM edges GROUP BY u, v),
{_bellman_ford(25, 5000.0)},
bm AS (SELECT m.mode, r25.source, r25.node, r25.cost / (m.speed * 1000.0 / 3600.0) AS cost, t.minutes
       FROM r25, {speeds} m, (VALUES (5), (10)) t(minutes) WHERE r25.cost / (m.speed * 1000.0 / 3600.0) <= t.minutes * 60.0)"""
    q["reachable_by_mode"] = by_mode + "\nSELECT mode, source, node, cost, minutes FROM bm\n"
    q["coverage_by_mode"] = by_mode + """,
l AS (SELECT bm.mode, bm.source, bm.minutes, nodes.x, nodes.y FROM bm JOIN nodes ON nodes.node_id = bm.node),
c AS (
  SELECT DISTINCT mode, source, minutes, cx, cy
  FROM l, generate_series(CAST(ceil((x - 200) / 100 - 0.5) AS BIGINT), CAST(floor((x + 200) / 100 - 0.5) AS BIGINT)) gx(cx),
       generate_series(CAST(ceil((y - 200) / 100 - 0.5) AS BIGINT), CAST(floor((y + 200) / 100 - 0.5) AS BIGINT)) gy(cy)
  WHERE ((2 * cx + 1) * 100 - 2 * x) * ((2 * cx + 1) * 100 - 2 * x) + ((2 * cy + 1) * 100 - 2 * y) * ((2 * cy + 1) * 100 - 2 * y) <= 160000),
rn AS (SELECT mode, source, minutes, count(*) AS nodes FROM l GROUP BY ALL),
k AS (SELECT mode, source, minutes, count(*) AS cells FROM c GROUP BY ALL)
SELECT rn.mode, rn.source, rn.minutes, rn.nodes, COALESCE(k.cells, 0) AS cells, COALESCE(k.cells, 0) * 10000 AS area_m2
FROM rn LEFT JOIN k USING (mode, source, minutes)
"""
    q["coverage_cells"] = reach + """,
l AS (SELECT b.source, b.minutes, nodes.x, nodes.y FROM b JOIN nodes ON nodes.node_id = b.node),
c AS (
  SELECT DISTINCT source, minutes, cx, cy
  FROM l, generate_series(CAST(ceil((x - 200) / 100 - 0.5) AS BIGINT), CAST(floor((x + 200) / 100 - 0.5) AS BIGINT)) gx(cx),
       generate_series(CAST(ceil((y - 200) / 100 - 0.5) AS BIGINT), CAST(floor((y + 200) / 100 - 0.5) AS BIGINT)) gy(cy)
  WHERE ((2 * cx + 1) * 100 - 2 * x) * ((2 * cx + 1) * 100 - 2 * x) + ((2 * cy + 1) * 100 - 2 * y) * ((2 * cy + 1) * 100 - 2 * y) <= 160000),
rn AS (SELECT source, minutes, count(*) AS nodes FROM l GROUP BY ALL),
k AS (SELECT source, minutes, count(*) AS cells FROM c GROUP BY ALL)
SELECT rn.source, rn.minutes, rn.nodes, COALESCE(k.cells, 0) AS cells, COALESCE(k.cells, 0) * 10000 AS area_m2
FROM rn LEFT JOIN k USING (source, minutes)
"""
    return q
