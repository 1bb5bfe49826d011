"""DuckDB oracle SQL for the bike queries."""

from __future__ import annotations

from citybeat.constants import BIKE_DURATION_EDGES, BIKE_DURATION_LABELS
from citybeat.functions.bins import bin_case_sql
from citybeat.plans.oracle_taxi import labels_sql


# The cleaned start is the event's time, cut to what its format writes; no string is parsed here.
RAW_BIKES = """
raw AS (
  SELECT
    CASE WHEN value >= 1 THEN 'R' || CAST(event_id AS VARCHAR) END AS ride_id,
    event_type AS rideable_type,
    CASE WHEN event_id % 17 = 0 OR event_id % 19 = 0 THEN NULL
         WHEN event_id % 5 IN (0, 4) THEN date_trunc('second', ts)
         WHEN event_id % 5 IN (1, 3) THEN date_trunc('minute', ts)
         ELSE ts END AS started_at,
    date_trunc('second', make_timestamp(epoch_us(ts) + CAST(floor(value * 60000000.0) AS BIGINT))) AS ended_at,
    CASE WHEN event_id % 5 <> 0 THEN 'Station ' || CAST(user_id % 40 AS VARCHAR) END AS start_station_name,
    CASE WHEN event_id % 23 <> 0 THEN CAST(user_id % 40 AS VARCHAR) END AS start_station_id,
    CASE WHEN event_id % 7 <> 0 THEN 'Station ' || CAST((user_id * 7 + event_id) % 40 AS VARCHAR) END AS end_station_name,
    CAST((user_id * 7 + event_id) % 40 AS VARCHAR) AS end_station_id,
    CAST(40.60 AS DOUBLE) + (user_id % 40) * CAST(0.005 AS DOUBLE) AS start_lat,
    CAST(-74.05 AS DOUBLE) + (user_id % 40) * CAST(0.004 AS DOUBLE) AS start_lng,
    CAST(40.60 AS DOUBLE) + ((user_id * 7 + event_id) % 40) * CAST(0.005 AS DOUBLE) AS end_lat,
    CAST(-74.05 AS DOUBLE) + ((user_id * 7 + event_id) % 40) * CAST(0.004 AS DOUBLE) AS end_lng,
    CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 4 = 0 THEN 'member' ELSE 'casual' END AS member_casual
  FROM events
)"""

BIKES_CTE = f"""{RAW_BIKES.strip()},
parsed AS (
  SELECT * FROM raw
  WHERE started_at IS NOT NULL AND ended_at IS NOT NULL AND start_station_id IS NOT NULL AND end_station_id IS NOT NULL
),
bikes AS (
  SELECT *, (epoch_us(ended_at) - epoch_us(started_at)) / 60000000.0 AS duration_min
  FROM parsed WHERE (epoch_us(ended_at) - epoch_us(started_at)) / 60000000.0 BETWEEN 0 AND 360
)"""

NATION_TRIPS = """
nt AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS ride_id,
         l_orderkey * 8 + l_linenumber AS ride_key,
         l_quantity AS duration_min,
         CAST(c_nationkey AS VARCHAR) AS start_station_id, n1.n_name AS start_station_name,
         CAST(40.5 AS DOUBLE) + c_nationkey * CAST(0.01 AS DOUBLE) AS start_lat, CAST(-74.1 AS DOUBLE) + c_nationkey * CAST(0.007 AS DOUBLE) AS start_lng,
         CAST(s_nationkey AS VARCHAR) AS end_station_id, n2.n_name AS end_station_name,
         CAST(40.5 AS DOUBLE) + s_nationkey * CAST(0.01 AS DOUBLE) AS end_lat, CAST(-74.1 AS DOUBLE) + s_nationkey * CAST(0.007 AS DOUBLE) AS end_lng
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
       JOIN supplier ON l_suppkey = s_suppkey
       LEFT JOIN nation n1 ON n1.n_nationkey = c_nationkey LEFT JOIN nation n2 ON n2.n_nationkey = s_nationkey
)"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_bikes"] = f"""
WITH {BIKES_CTE.strip()}
SELECT ride_id, rideable_type, started_at, ended_at, start_station_name, start_station_id, end_station_name,
       end_station_id, start_lat, start_lng, end_lat, end_lng, member_casual, duration_min
FROM bikes
"""
    q["top_flows"] = f"""
WITH {NATION_TRIPS.strip()},
f AS (
  SELECT start_station_id, end_station_id,
         arg_min(start_station_name, ride_key) AS start_station_name, arg_min(start_lat, ride_key) AS start_lat,
         arg_min(start_lng, ride_key) AS start_lng, arg_min(end_station_name, ride_key) AS end_station_name,
         arg_min(end_lat, ride_key) AS end_lat, arg_min(end_lng, ride_key) AS end_lng,
         count(ride_id) AS trip_count, sum(duration_min) AS dsum
  FROM nt GROUP BY start_station_id, end_station_id)
SELECT start_station_id, end_station_id, start_station_name, start_lat, start_lng, end_station_name, end_lat, end_lng,
       trip_count, floor(CASE WHEN trip_count > 0 THEN dsum / trip_count ELSE 0 END * 100.0 + 0.5) / 100.0 AS avg_duration_min
FROM f ORDER BY trip_count DESC, start_station_id, end_station_id LIMIT 50
"""
    q["top_stations"] = f"""
WITH {NATION_TRIPS.strip()}
SELECT start_station_id AS station_id, arg_min(start_station_name, ride_key) AS station_name,
       arg_min(start_lat, ride_key) AS lat, arg_min(start_lng, ride_key) AS lng, count(ride_id) AS trip_count
FROM nt GROUP BY start_station_id ORDER BY trip_count DESC, station_id LIMIT 20
"""
    q["hourly_by_user"] = f"""
WITH {BIKES_CTE.strip()}
SELECT CAST(hour(started_at) AS INTEGER) AS hour, member_casual, count(ride_id) AS trip_count
FROM bikes WHERE member_casual IS NOT NULL GROUP BY ALL
"""
    q["weekday_by_user"] = f"""
WITH {BIKES_CTE.strip()}
SELECT CAST(isodow(started_at) - 1 AS INTEGER) AS weekday_index, member_casual, count(ride_id) AS trip_count
FROM bikes WHERE member_casual IS NOT NULL GROUP BY ALL
"""
    q["type_share"] = f"""
WITH {BIKES_CTE.strip()},
c AS (SELECT rideable_type, count(ride_id) AS trip_count FROM bikes WHERE rideable_type IS NOT NULL GROUP BY ALL)
SELECT rideable_type, trip_count,
       CASE WHEN sum(trip_count) OVER () = 0 THEN 0.0
            ELSE round_even(trip_count / sum(trip_count) OVER () * 10000.0, 0) / 10000.0 END AS share
FROM c
"""
    q["member_share"] = f"""
WITH {BIKES_CTE.strip()},
c AS (SELECT member_casual, count(ride_id) AS trip_count FROM bikes WHERE member_casual IS NOT NULL GROUP BY ALL)
SELECT member_casual, trip_count,
       CASE WHEN sum(trip_count) OVER () = 0 THEN 0.0
            ELSE round_even(trip_count / sum(trip_count) OVER () * 10000.0, 0) / 10000.0 END AS share
FROM c
"""
    case = bin_case_sql("duration_min", BIKE_DURATION_EDGES, BIKE_DURATION_LABELS, right=True)
    q["bike_duration_bins"] = f"""
WITH {BIKES_CTE.strip()},
v AS (SELECT member_casual, {case} AS b, ride_id FROM bikes WHERE member_casual IS NOT NULL),
m AS (SELECT DISTINCT member_casual FROM v)
SELECT m.member_casual, l.duration_bin, count(v.ride_id) AS trip_count
FROM m CROSS JOIN {labels_sql(BIKE_DURATION_LABELS, 'duration_bin')} l
LEFT JOIN v ON v.member_casual = m.member_casual AND v.b = l.duration_bin
GROUP BY ALL
"""
    q["duration_member_pivot"] = f"""
WITH {BIKES_CTE.strip()},
v AS (SELECT member_casual, {case} AS b, ride_id FROM bikes WHERE member_casual IS NOT NULL),
m AS (SELECT DISTINCT member_casual FROM v),
g AS (SELECT l.duration_bin, m.member_casual, count(v.ride_id) AS n
      FROM m CROSS JOIN {labels_sql(BIKE_DURATION_LABELS, 'duration_bin')} l
      LEFT JOIN v ON v.member_casual = m.member_casual AND v.b = l.duration_bin GROUP BY ALL)
SELECT duration_bin, COALESCE(sum(n) FILTER (WHERE member_casual = 'member'), 0) AS member,
       COALESCE(sum(n) FILTER (WHERE member_casual = 'casual'), 0) AS casual
FROM g GROUP BY duration_bin
"""
    return q
