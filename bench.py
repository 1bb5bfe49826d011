"""Benchmark: run every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full with the no-op sink (nothing is collected)
and timed separately.  Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

    from citybeat.plans.catalog import queries
    from citybeat.session import get_spark

    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    qs = queries()
    # Untimed warm-up (JVM, code generation, Parquet footers) so that the
    # first timed query is not charged for it; every query is still timed in full.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey").write.format("noop").mode("overwrite").save()
    qs["trips_monthly"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name, fn in qs.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report and continue
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
        print(f"{name}: {times.get(name, 'FAILED')}", file=sys.stderr, flush=True)

    out = {
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf,
        "cpus": cpus,
    }
    if failed:
        out["failed"] = failed
    print(json.dumps(out), flush=True)
    return 0


if __name__ == "__main__":
    sys.exit(main())
