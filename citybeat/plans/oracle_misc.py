"""DuckDB oracle SQL for ridership, timestamp parsing, grids and sampling."""

from __future__ import annotations

from citybeat.plans.oracle_taxi import oracles as taxi_oracles

RIDERSHIP_CTE = """
rows AS (
  SELECT CASE WHEN o_orderpriority = '5-LOW' AND year(o_orderdate) = 1996 THEN '4-NOT SPECIFIED' ELSE o_orderpriority END AS mode,
         CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS ridership
  FROM orders
),
means AS (
  SELECT mode, year,
         CAST(round_even(sum(CAST(round_even(ridership * 100.0, 0) AS BIGINT)) / count(*) * 1000000.0, 0) AS BIGINT) AS c,
         sum(CAST(round_even(ridership * 100.0, 0) AS BIGINT)) / count(*) / 100.0 AS exact_mean
  FROM rows WHERE year IS NOT NULL GROUP BY mode, year
)"""

# Header and line bytes of the four columns; 262144 bytes a part at most, names counted with quotes.
SIZE_CAPPED_PARTS = """
WITH l AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_orderkey, l_linenumber, l_partkey, l_returnflag,
         length(l_orderkey::VARCHAR) + length(l_linenumber::VARCHAR) + length(l_partkey::VARCHAR) + length(l_returnflag) + 4 AS b
  FROM lineitem),
h AS (SELECT length('l_orderkey,l_linenumber,l_partkey,l_returnflag') + 1 AS header, max(b) AS widest FROM l),
r AS (
  SELECT year, b, coalesce(sum(b) OVER (PARTITION BY year ORDER BY l_orderkey, l_linenumber, l_partkey, l_returnflag
                                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM l),
p AS (
  SELECT year, CAST(floor(pos / (262144 - header - 8 - widest)) AS BIGINT) AS n, count(*) AS rows, CAST(sum(b) + any_value(header) AS BIGINT) AS bytes
  FROM r CROSS JOIN h GROUP BY 1, 2)
SELECT year, CAST(row_number() OVER (PARTITION BY year ORDER BY n) AS INTEGER) AS part, rows, bytes, bytes <= 262144 AS under_cap FROM p
"""

KNOWN = "('1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED')"
KNOWN_ORDERED = "(SELECT * FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4)) t(mode, ord))"


def oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    q["ridership_mean"] = f"WITH {RIDERSHIP_CTE.strip()} SELECT mode, year, exact_mean AS ridership FROM means"
    q["mode_totals"] = f"""
WITH {RIDERSHIP_CTE.strip()}
SELECT year, sum(c) / 100000000.0 AS total FROM means WHERE mode IN {KNOWN} GROUP BY year
"""
    q["mode_share"] = f"""
WITH {RIDERSHIP_CTE.strip()},
g AS (SELECT y.year, m.mode, COALESCE(means.c, 0) AS c
      FROM (SELECT DISTINCT year FROM means) y CROSS JOIN (SELECT DISTINCT mode FROM means) m
      LEFT JOIN means ON means.year = y.year AND means.mode = m.mode)
SELECT year, mode, c / 100000000.0 AS ridership, sum(c) OVER (PARTITION BY year) / 100000000.0 AS total,
       CASE WHEN sum(c) OVER (PARTITION BY year) = 0 THEN 0.0 ELSE c / sum(c) OVER (PARTITION BY year) END AS share
FROM g
"""
    q["latest_year_share"] = f"""
WITH {RIDERSHIP_CTE.strip()},
ly AS (SELECT max(year) AS year FROM means),
g AS (SELECT ly.year, k.mode, COALESCE(means.c, 0) AS c FROM ly CROSS JOIN {KNOWN_ORDERED} k
      LEFT JOIN means ON means.year = ly.year AND means.mode = k.mode)
SELECT year, mode, c / 100000000.0 AS ridership,
       c / CASE WHEN sum(c) OVER () = 0 THEN 1 ELSE sum(c) OVER () END AS share
FROM g
"""
    q["featured_years"] = f"""
WITH {RIDERSHIP_CTE.strip()},
r AS (SELECT mode, year, c, row_number() OVER (PARTITION BY mode ORDER BY year) - 1 AS i,
             count(*) OVER (PARTITION BY mode) AS n FROM means),
t AS (SELECT year, sum(c) AS tc FROM means GROUP BY year)
SELECT mode, year, c / 100000000.0 AS ridership, tc / 100000000.0 AS total, CASE WHEN tc = 0 THEN 0.0 ELSE c / tc END AS share
FROM r JOIN t USING (year)
WHERE n <= 4 OR i IN (0, floor(n / 3), floor(2 * n / 3), n - 1)
"""
    q["year_mode_pivot"] = f"""
WITH {RIDERSHIP_CTE.strip()},
g AS (SELECT y.year, k.mode, k.ord, COALESCE(means.c, 0) AS c
      FROM (SELECT DISTINCT year FROM means) y CROSS JOIN {KNOWN_ORDERED} k
      LEFT JOIN means ON means.year = y.year AND means.mode = k.mode),
s AS (SELECT *, sum(c) OVER (PARTITION BY year ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS y1 FROM g)
SELECT year, mode, c / 100000000.0 AS ridership, (y1 - c) / 100000000.0 AS y0, y1 / 100000000.0 AS y1 FROM s
"""
    q["distinct_years"] = f"WITH {RIDERSHIP_CTE.strip()} SELECT DISTINCT year FROM rows WHERE year IS NOT NULL"
    # Both columns must give back the event's time, cut to the unit it was written in.
    q["epoch_units"] = """
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN epoch_us(ts) // 1000000 WHEN 1 THEN epoch_us(ts) // 1000
                         WHEN 2 THEN epoch_us(ts) ELSE epoch_us(ts) * 1000 END AS epoch_value,
       CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('millisecond', ts) ELSE ts END AS from_epoch,
       CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y%m%d%H%M%S') WHEN 1 THEN strftime(ts, '%Y%m%d%H%M')
                         ELSE strftime(ts, '%Y%m%d') END AS digits,
       CASE event_id % 3 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('minute', ts)
                         ELSE CAST(date_trunc('day', ts) AS TIMESTAMP) END AS from_digits
FROM events
"""
    tip_sql = taxi_oracles()["tip_bins"].strip()
    q["category_grid"] = f"""
WITH tb AS ({tip_sql}),
s AS (SELECT DISTINCT service FROM tb),
c AS (SELECT * FROM (VALUES ('0%'), ('0-5%'), ('5-10%'), ('10-15%'), ('15-20%'), ('20-25%'), ('25%+')) t(tip_bin))
SELECT s.service, c.tip_bin, COALESCE(tb.trips, 0) AS trips
FROM s CROSS JOIN c LEFT JOIN tb ON tb.service = s.service AND tb.tip_bin = c.tip_bin
"""
    q["systematic_sample"] = """
WITH r AS (
  SELECT event_id, event_type, ts, value,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM events)
SELECT event_id, event_type, ts, value FROM r
WHERE n <= 500 OR pos % greatest(1, CAST(ceil(n / 500.0) AS BIGINT)) = 0
"""
    return q
