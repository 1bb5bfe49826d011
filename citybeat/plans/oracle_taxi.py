"""DuckDB oracle SQL for the taxi queries (independent re-statement of the bindings)."""

from __future__ import annotations

from citybeat.constants import DISTANCE_EDGES, DISTANCE_LABELS, DURATION_EDGES, DURATION_LABELS, TIP_EDGES, TIP_LABELS
from citybeat.functions.bins import bin_case_sql


def labels_sql(labels: list[str], name: str) -> str:
    rows = ", ".join(f"('{x}')" for x in labels)
    return f"(SELECT * FROM (VALUES {rows}) t({name}))"


TRIPS_CTE = """
trips AS (
  SELECT l_returnflag AS service,
         CASE WHEN l_returnflag = 'A' THEN 'fhv' WHEN l_returnflag = 'R' THEN 'hvfhs' ELSE 'yellow' END AS kind,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         l_extendedprice / 5000.0 AS trip_distance,
         (l_quantity * 60) / 60.0 AS duration_min,
         l_extendedprice AS base_fare,
         l_extendedprice * l_discount AS tip_amount,
         CASE WHEN l_discount <> 0 THEN l_quantity * l_discount END AS tolls_amount,
         CASE WHEN l_linenumber <> 6 THEN l_quantity / 10.0 END AS extra,
         l_extendedprice * l_tax AS mta_tax,
         CASE WHEN l_linenumber <> 5 THEN l_tax - 0.07 END AS airport_fee,
         CAST(l_linenumber AS DOUBLE) AS ratecode,
         CAST(CASE WHEN l_linenumber = 4 THEN -l_suppkey ELSE l_suppkey END AS INTEGER) AS pu,
         CAST(l_partkey % 100 AS INTEGER) AS do_,
         CASE WHEN l_discount = 0 THEN NULL WHEN l_linestatus = 'O' THEN ' y' ELSE '1' END AS smf,
         l_orderkey
  FROM lineitem
  WHERE year(l_shipdate) BETWEEN 1996 AND 2000
)"""

ZONES_CTE = """
zones AS (
  SELECT CAST(s_suppkey AS INTEGER) AS loc, r_name AS borough, n_name AS zone
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def _binned(expr_filter: str, value: str, edges, labels, bin_name: str) -> str:
    case = bin_case_sql(value, edges, labels)
    return f"""
WITH {TRIPS_CTE.strip()},
v AS (SELECT service, {case} AS b FROM trips WHERE {expr_filter}),
s AS (SELECT DISTINCT service FROM v)
SELECT s.service, l.{bin_name}, count(v.b) AS trips
FROM s CROSS JOIN {labels_sql(labels, bin_name)} l
LEFT JOIN v ON v.service = s.service AND v.b = l.{bin_name}
GROUP BY s.service, l.{bin_name}
"""


def _round(expr: str, digits: int) -> str:
    return f"(round_even(({expr}) * {10 ** digits}.0, 0) / {10 ** digits}.0)"


SHARED_FLAG = """CASE WHEN kind = 'fhv' THEN COALESCE(TRY_CAST(smf AS DOUBLE), 0) = 1
                      WHEN kind = 'hvfhs' THEN upper(trim(smf)) = 'Y' END"""

AIRPORT_FLAG = "(COALESCE(airport_fee, 0) > 0 OR COALESCE(ratecode IN (2, 3), false))"


def _flag_share(flag: str, where: str, name: str) -> str:
    return f"""
WITH {TRIPS_CTE.strip()},
w AS (SELECT service, count(*) FILTER (WHERE ({flag}) = true) AS t, count(*) FILTER (WHERE ({flag}) = false) AS f
      FROM trips WHERE {where} GROUP BY service),
l AS (SELECT service, true AS {name}, t AS trips FROM w UNION ALL SELECT service, false, f FROM w)
SELECT service, {name}, trips, {_round('trips / sum(trips) OVER (PARTITION BY service)', 4)} AS share FROM l
"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["trips_monthly"] = f"""
WITH {TRIPS_CTE.strip()}
SELECT service, year, month, count(*) AS trips FROM trips GROUP BY service, year, month
"""
    q["observed_days"] = """
SELECT event_type AS service, count(DISTINCT CAST(ts AS DATE)) AS days FROM events
WHERE year(ts) BETWEEN 2024 AND 2024 GROUP BY event_type
"""
    q["pickup_counts"] = f"""
WITH {TRIPS_CTE.strip()}
SELECT service, year, pu AS PULocationID, count(*) AS trips FROM trips GROUP BY ALL
"""
    q["od_counts"] = f"""
WITH {TRIPS_CTE.strip()}
SELECT service, year, pu AS PULocationID, do_ AS DOLocationID, count(*) AS trips FROM trips GROUP BY ALL
"""
    q["trips_dow_hour_avg"] = f"""
WITH t AS (
  SELECT event_type AS service, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INTEGER) AS hour,
         CAST(isodow(ts) - 1 AS INTEGER) AS dow
  FROM events WHERE year(ts) BETWEEN 2024 AND 2024),
c AS (SELECT service, dow, hour, count(*) AS n FROM t GROUP BY ALL),
d AS (SELECT service, dow, count(DISTINCT date) AS days FROM t GROUP BY ALL)
SELECT c.service, c.dow, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][c.dow + 1] AS dow_label, c.hour,
       {_round('CASE WHEN days > 0 THEN n / days ELSE 0 END', 2)} AS avg_trips
FROM c JOIN d USING (service, dow)
"""
    q["distance_bins"] = _binned("trip_distance > 0 AND trip_distance < 200", "trip_distance", DISTANCE_EDGES, DISTANCE_LABELS, "distance_bin")
    q["duration_bins"] = _binned("duration_min > 0 AND duration_min < 600", "duration_min", DURATION_EDGES, DURATION_LABELS, "duration_bin")
    tip_case = bin_case_sql("rate", TIP_EDGES, TIP_LABELS)
    q["tip_bins"] = f"""
WITH {TRIPS_CTE.strip()},
r AS (SELECT service, tip_amount / base_fare * 100.0 AS rate FROM trips WHERE base_fare > 0 AND tip_amount IS NOT NULL),
v AS (SELECT service, CASE WHEN rate = 0 THEN '0%' ELSE {tip_case} END AS b, rate FROM r WHERE rate >= 0),
s AS (SELECT service, count(*) FILTER (WHERE rate > 0) AS pos FROM v GROUP BY service),
g AS (
  SELECT s.service, l.tip_bin, count(v.b) AS trips, s.pos
  FROM s CROSS JOIN {labels_sql(['0%'] + TIP_LABELS, 'tip_bin')} l
  LEFT JOIN v ON v.service = s.service AND v.b = l.tip_bin
  GROUP BY s.service, l.tip_bin, s.pos)
SELECT service, tip_bin, trips FROM g WHERE CASE WHEN tip_bin = '0%' THEN trips > 0 ELSE pos > 0 END
"""
    dec = "CAST(COALESCE({c}, 0) AS DECIMAL(38,6))"
    comp = {
        "Base fare": ["base_fare"],
        "Tips": ["tip_amount"],
        "Tolls": ["tolls_amount"],
        "Taxes & funds": ["mta_tax"],
        "Surcharges": ["extra", "airport_fee"],
    }
    sums = ",\n  ".join(
        f"CAST(SUM({' + '.join(dec.format(c=c) for c in cols)}) AS DOUBLE) AS \"{name}\"" for name, cols in comp.items()
    )
    unions = " UNION ALL ".join(
        f"SELECT service, '{name}' AS component, \"{name}\" AS total, n FROM w" for name in comp
    )
    q["fare_components"] = f"""
WITH {TRIPS_CTE.strip()},
w AS (SELECT service, count(*) AS n,
  {sums}
  FROM trips GROUP BY service)
SELECT service, component, {_round('total / n', 4)} AS avg_amount FROM ({unions}) x
"""
    q["airport_share"] = _flag_share(AIRPORT_FLAG, "true", "airport_trip")
    q["shared_share"] = _flag_share(SHARED_FLAG, "kind IN ('fhv', 'hvfhs')", "shared_trip")
    q["provider_share"] = f"""
WITH {TRIPS_CTE.strip()},
p AS (
  SELECT CASE 'HV000' || substr(o_orderpriority, 1, 1)
           WHEN 'HV0002' THEN 'Juno' WHEN 'HV0003' THEN 'Uber' WHEN 'HV0004' THEN 'Via' WHEN 'HV0005' THEN 'Lyft'
           ELSE 'HV000' || substr(o_orderpriority, 1, 1) END AS provider
  FROM trips JOIN orders ON l_orderkey = o_orderkey
  WHERE kind = 'hvfhs'),
c AS (SELECT provider, count(*) AS trips FROM p GROUP BY provider)
SELECT provider, trips, {_round('trips / sum(trips) OVER ()', 4)} AS share FROM c
"""
    q["zone_borough_share"] = f"""
WITH {TRIPS_CTE.strip()}, {ZONES_CTE.strip()},
b AS (SELECT service, COALESCE(z.borough, 'Unknown') AS Borough, count(*) AS trips
      FROM trips LEFT JOIN zones z ON z.loc = trips.pu GROUP BY ALL)
SELECT service, Borough, trips, {_round('trips / sum(trips) OVER (PARTITION BY service)', 4)} AS share FROM b
"""
    q["top_zones"] = f"""
WITH {TRIPS_CTE.strip()}, {ZONES_CTE.strip()},
c AS (SELECT service, year, pu AS PULocationID, count(*) AS trips FROM trips GROUP BY ALL),
l AS (SELECT * FROM c WHERE year = (SELECT max(year) FROM c c2 WHERE c2.service = c.service)),
r AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY trips DESC, PULocationID) AS rn FROM l)
SELECT service, year, PULocationID, trips, COALESCE(z.borough, 'Unknown') AS Borough, COALESCE(z.zone, 'Unknown') AS Zone
FROM r LEFT JOIN zones z ON z.loc = r.PULocationID WHERE rn <= 20
"""
    q["top_od"] = f"""
WITH {TRIPS_CTE.strip()}, {ZONES_CTE.strip()},
c AS (SELECT service, year, pu AS PULocationID, do_ AS DOLocationID, count(*) AS trips FROM trips GROUP BY ALL),
l AS (SELECT * FROM c WHERE year = (SELECT max(year) FROM c c2 WHERE c2.service = c.service)),
r AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY trips DESC, PULocationID, DOLocationID) AS rn FROM l)
SELECT service, year, PULocationID, DOLocationID, trips,
       COALESCE(o.borough, 'Unknown') AS OriginBorough, COALESCE(o.zone, 'Unknown') AS OriginZone,
       COALESCE(d.borough, 'Unknown') AS DestBorough, COALESCE(d.zone, 'Unknown') AS DestZone
FROM r LEFT JOIN zones o ON o.loc = r.PULocationID LEFT JOIN zones d ON d.loc = r.DOLocationID WHERE rn <= 20
"""
    q["top_items_with_fallback"] = f"""
WITH {TRIPS_CTE.strip()},
t AS (SELECT service, year, CASE WHEN service = 'R' AND year = 2000 THEN ((pu % 100) + 100) % 100 ELSE pu END AS PULocationID FROM trips),
c AS (SELECT service, year, PULocationID, count(*) AS trips FROM t GROUP BY ALL),
py AS (SELECT service, year, count(*) AS n FROM c GROUP BY ALL),
st AS (SELECT service, max(year) AS latest, sum(n) AS n_all, arg_max(n, year) AS n_latest FROM py GROUP BY service),
k AS (SELECT c.* FROM c JOIN st USING (service) WHERE c.year = st.latest OR st.n_latest < least(150, st.n_all)),
r AS (SELECT *, row_number() OVER (PARTITION BY service ORDER BY trips DESC, year DESC, PULocationID) AS rn FROM k)
SELECT service, year, PULocationID, trips FROM r WHERE rn <= 150
"""
    q["folder_trips"] = """
SELECT 'fhvhv' AS service, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       count(*) AS trips, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS minutes,
       count(*) FILTER (WHERE l_extendedprice / 5000.0 >= 5.0) AS long_trips,
       count(*) FILTER (WHERE l_linestatus = 'O') AS shared,
       count(*) FILTER (WHERE l_linestatus = 'O' OR l_discount > 0) AS shared_known
FROM lineitem WHERE year(l_shipdate) BETWEEN 1996 AND 2000 GROUP BY ALL
"""
    return q
