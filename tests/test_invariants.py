"""Invariants on the driver tables: shares sum to one, bins add up, partition independence."""

import pytest
from pyspark.sql import functions as F

from citybeat.plans import bindings as B
from citybeat.plans.catalog import queries
from tests.conftest import SF001


def test_bins_add_up_to_filtered_trips(spark):
    t = B.trips(spark, SF001)
    n = t.filter((F.col("trip_distance") > 0) & (F.col("trip_distance") < 200)).count()
    total = queries()["distance_bins"](spark, SF001).agg(F.sum("trips")).first()[0]
    assert total == n


@pytest.mark.parametrize("name", ["airport_share", "zone_borough_share", "provider_share", "member_share"])
def test_shares_sum_to_one(spark, name):
    df = queries()[name](spark, SF001)
    key = "service" if "service" in df.columns else None
    sums = df.groupBy(*([key] if key else [])).agg(F.sum("share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-3 for r in sums)


@pytest.mark.parametrize(
    "name", ["top_flows", "tip_bins", "report_unpivot_borough", "nearest_stop", "route_overlap", "systematic_sample", "reachable"]
)
def test_partition_count_does_not_change_results(spark, name):
    prev = spark.conf.get("spark.sql.shuffle.partitions")
    out = []
    try:
        for n in ("1", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(sorted(tuple(r) for r in queries()[name](spark, SF001).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", prev)
    assert out[0] == out[1]


def test_top_zones_are_a_subset_of_latest_year_counts(spark):
    top = queries()["top_zones"](spark, SF001)
    counts = queries()["pickup_counts"](spark, SF001)
    latest = counts.groupBy("service").agg(F.max("year").alias("year"))
    pool = counts.join(latest, ["service", "year"])
    missing = top.select("service", "year", "PULocationID", "trips").exceptAll(pool.select("service", "year", "PULocationID", "trips"))
    assert missing.count() == 0
    # nothing outside the top-k beats the k-th row of its service
    kth = top.groupBy("service").agg(F.min("trips").alias("kth"), F.count(F.lit(1)).alias("n"))
    better = pool.join(top.select("service", "PULocationID"), ["service", "PULocationID"], "left_anti").join(kth, "service")
    assert better.filter(F.col("trips") > F.col("kth")).count() == 0
