"""DuckDB oracle for the report round trip: the tidy rows counted directly from L."""

from __future__ import annotations

from citybeat.plans.oracle_traffic import _title

BASE = """
base AS (
  SELECT CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'rejects_p5_' || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx'
              ELSE 'rejects_p' || substr(o_orderpriority, 1, 1) || '_q' || CAST(quarter(l_shipdate) AS VARCHAR) || '-'
                   || CAST(year(l_shipdate) AS VARCHAR) || '.xlsx' END AS source_file,
         CASE WHEN substr(o_orderpriority, 1, 1) = '5' THEN 'UNKNOWN'
              ELSE 'Q' || CAST(quarter(l_shipdate) AS VARCHAR) || '-' || CAST(year(l_shipdate) AS VARCHAR) END AS quarter,
         monthname(l_shipdate) AS sheet,
         trim(substr(o_orderpriority, 3, 100)) AS violation_type,
         'Reason ' || l_returnflag || l_linestatus AS reject_reason,
         ['SUN', 'MON', 'TUE', 'WED', 'THU', 'FRI', 'SAT'][dayofweek(l_shipdate) + 1] AS day,
         CASE WHEN l_linenumber <= 2 THEN '00-08' WHEN l_linenumber <= 4 THEN '08-16' ELSE '16-24' END AS time_window,
         r_name,
         'Board ' || CAST(l_partkey % 12 + 1 AS VARCHAR) AS community_board
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
       JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)"""


def oracles() -> dict[str, str]:
    head = "source_file, quarter, sheet, sheet AS month, violation_type"
    q: dict[str, str] = {}
    q["report_unpivot_day"] = f"""
WITH {BASE.strip()}
SELECT {head}, 'day_of_week' AS section, reject_reason, day, time_window, '' AS borough, '' AS community_board,
       count(*) AS count
FROM base GROUP BY ALL
"""
    q["report_unpivot_borough"] = f"""
WITH {BASE.strip()}
SELECT {head}, 'borough' AS section, reject_reason, '' AS day, '' AS time_window, {_title('r_name')} AS borough,
       '' AS community_board, count(*) AS count
FROM base GROUP BY ALL
"""
    q["report_unpivot_board"] = f"""
WITH {BASE.strip()}
SELECT {head}, 'community_board' AS section, reject_reason, '' AS day, '' AS time_window, '' AS borough,
       community_board, count(*) AS count
FROM base GROUP BY ALL
"""
    return q
