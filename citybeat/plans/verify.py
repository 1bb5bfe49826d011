"""Local re-run of the correctness gate: Spark query vs DuckDB oracle.

    python -m citybeat.plans.verify /root/testdata/sf0.01 [name ...]

Compares column names, row counts and the multiset of rows (columns sorted
by name, values rendered canonically).  Prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

from citybeat.plans.tables import TABLES


def _canon(v):
    if v is None:
        return "None"
    if isinstance(v, float):
        if math.isnan(v):
            return "None"
        return repr(float(v))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _canon(v.item())
        except (ValueError, AttributeError):
            pass
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_canon(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _canon(v.tolist())
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_canon(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_canon(r[i]) for i in order) for r in records), [columns[i] for i in order]


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, sf_dir: str, name: str, fn, sql: str | None, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    spark_s = time.time() - t0
    scols = sdf.columns
    res = {"name": name, "rows": len(srows), "spark_s": round(spark_s, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    cur = con.execute(sql)
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    a, acols = rows_of(scols, srows)
    b, bcols = rows_of(ocols, orows)
    if acols != bcols:
        res["status"] = f"COLUMNS {acols} vs {bcols}"
    elif len(a) != len(b):
        res["status"] = f"ROWCOUNT {len(a)} vs {len(b)}"
    elif a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y]
        res["status"] = f"VALUES {len(diff)} differ; first {diff[0]}"
    else:
        res["status"] = "ok"
    return res


def main(argv: list[str]) -> int:
    from citybeat.plans.catalog import oracle_sql, queries
    from citybeat.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, sf_dir, name, fn, os_.get(name), con)
        except Exception as exc:  # noqa: BLE001
            r = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{bad} failing", flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
