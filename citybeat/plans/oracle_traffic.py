"""DuckDB oracle SQL for the traffic-count queries."""

from __future__ import annotations


def _title(x: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
        f"lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


TRAFFIC_CTE = f"""
raw AS (
  SELECT
    CASE WHEN event_id % 2 = 0 THEN lower(r_name) ELSE '  ' || r_name || ' ' END AS Boro,
    CASE WHEN event_id % 31 <> 0 THEN CAST(year(ts) AS INTEGER) END AS Yr,
    CASE WHEN event_id % 29 = 0 THEN 2 ELSE CAST(month(ts) AS INTEGER) END AS M,
    CASE WHEN event_id % 29 = 0 THEN 30 ELSE CAST(day(ts) AS INTEGER) END AS D,
    CAST(hour(ts) AS INTEGER) AS HH,
    CASE WHEN event_type = 'error' AND event_id % 3 = 0 THEN -CAST(floor(value) AS INTEGER) - 1
         ELSE CAST(floor(value) AS INTEGER) END AS Vol,
    'Street ' || CAST(user_id % 17 AS VARCHAR) AS street,
    CASE WHEN user_id % 3 = 0 THEN '' ELSE 'Ave ' || CAST(user_id % 5 AS VARCHAR) END AS fromSt,
    CASE WHEN user_id % 7 = 0 THEN NULL ELSE ' Blvd ' || CAST(user_id % 4 AS VARCHAR) || ' ' END AS toSt,
    CASE event_type WHEN 'click' THEN ' nb' WHEN 'view' THEN 'SB ' WHEN 'purchase' THEN '' WHEN 'error' THEN 'eb' END AS Direction
  FROM events LEFT JOIN region ON user_id % 5 = r_regionkey
),
k AS (
  SELECT {_title('Boro')} AS Boro, Yr, M, D, HH, Vol, street, fromSt, toSt,
         CASE WHEN upper(trim(Direction)) IS NULL OR upper(trim(Direction)) = '' THEN 'UNK' ELSE upper(trim(Direction)) END AS Direction,
         try_cast(printf('%04d-%02d-%02d', Yr, M, D) AS DATE) AS dt
  FROM raw
  WHERE Boro IS NOT NULL AND Yr IS NOT NULL AND M IS NOT NULL AND D IS NOT NULL AND HH IS NOT NULL AND Vol IS NOT NULL
    AND Vol >= 0
),
traffic AS (
  SELECT *, CAST(isodow(dt) - 1 AS INTEGER) AS weekday, isodow(dt) - 1 >= 5 AS is_weekend,
         COALESCE(NULLIF(concat_ws(' | ', NULLIF(trim(street), ''), NULLIF(trim(fromSt), ''), NULLIF(trim(toSt), ''),
                                   NULLIF(trim(Direction), '')), ''), 'Unknown') AS corridor
  FROM k WHERE dt IS NOT NULL
)"""


def _avg(keys: str, select: str | None = None) -> str:
    sel = select or keys
    return f"""
WITH {TRAFFIC_CTE.strip()}
SELECT {sel}, sum(Vol) / count(Vol) AS avg_volume FROM traffic GROUP BY {keys}
"""


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["clean_traffic"] = f"""
WITH {TRAFFIC_CTE.strip()}
SELECT Boro, Yr, M, D, HH, Vol, street, fromSt, toSt, Direction, weekday, is_weekend, corridor FROM traffic
"""
    q["hourly_by_borough"] = _avg("Boro, HH", "Boro, HH AS hour")
    q["monthly_by_borough"] = _avg("Boro, M", "Boro, M AS month")
    q["weekend_by_borough"] = _avg("Boro, is_weekend")
    q["weekday_share"] = _avg("is_weekend")
    q["direction_by_borough"] = _avg("Boro, Direction")
    q["day_of_week"] = _avg("weekday", "weekday AS weekday_index")
    q["borough_avg"] = f"""
WITH {TRAFFIC_CTE.strip()},
a AS (SELECT Boro, sum(Vol) / count(Vol) AS avg_volume FROM traffic GROUP BY Boro)
SELECT Boro, avg_volume,
       CASE WHEN sum(avg_volume) OVER () = 0 THEN 0.0
            ELSE round_even(avg_volume / sum(avg_volume) OVER () * 10000.0, 0) / 10000.0 END AS share
FROM a
"""
    q["top_corridors"] = f"""
WITH {TRAFFIC_CTE.strip()}
SELECT corridor, CAST(sum(Vol) AS BIGINT) AS total_volume FROM traffic GROUP BY corridor
ORDER BY total_volume DESC, corridor LIMIT 15
"""
    q["weekend_pivot"] = f"""
WITH {TRAFFIC_CTE.strip()},
a AS (SELECT Boro, is_weekend, sum(Vol) / count(Vol) AS v FROM traffic GROUP BY ALL),
o AS (SELECT * FROM (VALUES ('Africa'), ('America'), ('Asia'), ('Europe'), ('Middle East'), ('Antarctica')) t(Boro))
SELECT o.Boro, COALESCE(max(v) FILTER (WHERE NOT is_weekend), 0.0) AS weekday,
       COALESCE(max(v) FILTER (WHERE is_weekend), 0.0) AS weekend
FROM o LEFT JOIN a USING (Boro) GROUP BY o.Boro
"""
    return q
