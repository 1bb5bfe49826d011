"""Write query results as chart-ready CSV folders.

    python -m citybeat.plans.export <tables dir> <output dir> [name ...]

Each query is written by Spark's tasks to ``<output dir>/<name>/`` (header
in every part); nothing is collected to the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from citybeat.plans.catalog import queries


def export_outputs(spark: SparkSession, sf_dir: str, out_dir: str, names: Sequence[str] = ()) -> list[str]:
    """Run the named queries (all when empty) and write each as CSV; returns the paths."""
    written = []
    for name, fn in queries().items():
        if names and name not in names:
            continue
        path = f"{out_dir.rstrip('/')}/{name}"
        fn(spark, sf_dir).write.mode("overwrite").option("header", True).csv(path)
        written.append(path)
    return written


def main(argv: list[str]) -> int:
    from citybeat.session import get_spark

    if len(argv) < 2:
        print(__doc__)
        return 2
    spark = get_spark()
    for path in export_outputs(spark, argv[0], argv[1], argv[2:]):
        print(path)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
