"""Taxi / for-hire trip aggregates.

Input is the canonical trip frame of ``citybeat.sources.trips.normalize_trips``
(one row per valid trip).  Every operator is one or two shuffles on small
keys with map-side partial aggregation; lookups are joined after the
aggregation, when the big side has shrunk to one row per key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.constants import (
    COMPONENT_GROUPS,
    DISTANCE_EDGES,
    DISTANCE_LABELS,
    DISTANCE_OPEN_RANGE,
    DOW_LABELS,
    DURATION_EDGES,
    DURATION_LABELS,
    DURATION_OPEN_RANGE,
    PROVIDER_NAMES,
    TIP_EDGES,
    TIP_LABELS,
    TIP_ZERO_LABEL,
    TOP_PAIRS,
    TOP_ZONES,
)
from citybeat.functions.bins import left_closed_bin
from citybeat.functions.numeric import round_half_even
from citybeat.operators.common import (
    latest_per_group,
    share_of_total,
    share_within,
    top_k_per_group,
    top_k_with_fallback,
    zero_filled_counts,
)


def chart_ready(df: DataFrame, services: list[str], year_range: tuple[int, int], measure: str) -> DataFrame:
    """Rows a chart can use: known service, finite year / month / measure,
    year inside the range and month 1..12 (P19)."""
    lo, hi = year_range
    m = F.col(measure).cast("double")
    ok = (
        F.col("service").isin(services)
        & F.col("year").between(lo, hi)
        & F.col("month").between(1, 12)
        & m.isNotNull()
        & ~F.isnan(m)
        & (F.abs(m) != F.lit(float("inf")))
    )
    return df.filter(ok)


def monthly_volume(trips: DataFrame) -> DataFrame:
    """service, year, month -> trips (A1)."""
    return trips.groupBy("service", "year", "month").agg(F.count(F.lit(1)).alias("trips"))


def dow_hour_average(trips: DataFrame) -> DataFrame:
    """service, dow, hour -> average trips per observed calendar day of that weekday.

    Both the numerator and the day count come from one (service, date, hour)
    pre-aggregate, so the trip table is scanned and shuffled once.
    """
    daily = trips.groupBy("service", "date", "hour").agg(F.count(F.lit(1)).alias("n"))
    daily = daily.withColumn("dow", F.weekday("date"))
    counts = daily.groupBy("service", "dow", "hour").agg(F.sum("n").alias("n"))
    days = daily.groupBy("service", "dow").agg(F.count_distinct("date").alias("days"))
    labels = F.array(*[F.lit(x) for x in DOW_LABELS])
    return (
        counts.join(days, on=["service", "dow"], how="left")
        .select(
            "service",
            "dow",
            F.element_at(labels, F.col("dow") + 1).alias("dow_label"),
            "hour",
            round_half_even(F.when(F.col("days") > 0, F.col("n") / F.col("days")).otherwise(F.lit(0.0)), 2).alias("avg_trips"),
        )
    )


def observed_days(trips: DataFrame) -> DataFrame:
    """Distinct observed pickup dates per service."""
    return trips.groupBy("service").agg(F.count_distinct("date").alias("days"))


def distance_bins(trips: DataFrame) -> DataFrame:
    """service, distance_bin -> trips for 0 < miles < 200, left-closed bins."""
    lo, hi = DISTANCE_OPEN_RANGE
    valid = trips.filter((F.col("trip_distance") > lo) & (F.col("trip_distance") < hi))
    label = left_closed_bin("trip_distance", DISTANCE_EDGES, DISTANCE_LABELS)
    return zero_filled_counts(valid, "service", label, DISTANCE_LABELS, "distance_bin")


def duration_bins(trips: DataFrame) -> DataFrame:
    """service, duration_bin -> trips for 0 < minutes < 600."""
    lo, hi = DURATION_OPEN_RANGE
    valid = trips.filter((F.col("duration_min") > lo) & (F.col("duration_min") < hi))
    label = left_closed_bin("duration_min", DURATION_EDGES, DURATION_LABELS)
    return zero_filled_counts(valid, "service", label, DURATION_LABELS, "duration_bin")


def tip_rate_bins(trips: DataFrame) -> DataFrame:
    """service, tip_bin -> trips.

    rate = tip / fare * 100 for fare > 0 and a known tip; negative rates are
    dropped; an exact 0 has its own '0%' bucket, emitted only when non-zero;
    the positive bins are zero-filled for services with any positive rate.
    """
    rate = F.col("tip_amount") / F.col("base_fare") * 100.0
    rated = trips.filter((F.col("base_fare") > 0) & F.col("tip_amount").isNotNull()).select("service", rate.alias("rate"))
    rated = rated.filter(F.col("rate") >= 0)
    label = F.when(F.col("rate") == 0, F.lit(TIP_ZERO_LABEL)).otherwise(left_closed_bin("rate", TIP_EDGES, TIP_LABELS))
    counted = zero_filled_counts(
        rated, "service", label, [TIP_ZERO_LABEL] + TIP_LABELS, "tip_bin", extra=[F.count_if(F.col("rate") > 0).alias("__pos")]
    )
    keep = F.when(F.col("tip_bin") == TIP_ZERO_LABEL, F.col("trips") > 0).otherwise(F.col("__pos") > 0)
    return counted.filter(keep).drop("__pos")


def fare_components(trips: DataFrame) -> DataFrame:
    """service, component -> average amount over *all* valid trips, 4 decimals (A5).

    A component is reported for a service when any of its columns exists in
    that service's files (``has_*`` flags); missing values count as 0.  Sums
    are exact decimals, so the result does not depend on partitioning.
    """
    aggs = [F.count(F.lit(1)).alias("__trips")]
    for i, (component, cols) in enumerate(COMPONENT_GROUPS.items()):
        amount = sum((F.coalesce(F.col(c), F.lit(0.0)).cast("decimal(38,6)") for c in cols), F.lit(0).cast("decimal(38,6)"))
        aggs.append(F.sum(amount).alias(f"__s{i}"))
        present = [F.col(f"has_{c}") for c in cols]
        aggs.append(F.max(present[0] if len(present) == 1 else F.greatest(*present)).alias(f"__h{i}"))
    wide = trips.groupBy("service").agg(*aggs)
    rows = [
        F.struct(F.lit(component).alias("component"), F.col(f"__s{i}").alias("total"), F.col(f"__h{i}").alias("present"))
        for i, component in enumerate(COMPONENT_GROUPS)
    ]
    long = wide.select("service", "__trips", F.inline(F.array(*rows)))
    return long.filter(F.col("present") & (F.col("__trips") > 0)).select(
        "service",
        "component",
        round_half_even(F.col("total").cast("double") / F.col("__trips"), 4).alias("avg_amount"),
    )


def _flag_share(trips: DataFrame, flag_col: str, has: F.Column, out_col: str) -> DataFrame:
    """True/False counts per service (both always present) and their share."""
    subset = trips.filter(has)
    wide = subset.groupBy("service").agg(
        F.count_if(F.col(flag_col) == True).alias("t"),  # noqa: E712
        F.count_if(F.col(flag_col) == False).alias("f"),  # noqa: E712
    )
    rows = F.array(
        F.struct(F.lit(True).alias(out_col), F.col("t").alias("trips")),
        F.struct(F.lit(False).alias(out_col), F.col("f").alias("trips")),
    )
    long = wide.select("service", F.inline(rows))
    return share_within(long, "service", "trips")


def airport_share(trips: DataFrame) -> DataFrame:
    """service, airport_trip -> trips, share."""
    has = F.col("has_airport_fee") | F.col("has_ratecode")
    return _flag_share(trips, "airport_trip", has, "airport_trip")


def shared_share(trips: DataFrame) -> DataFrame:
    """service, shared_trip -> trips, share for fhv / hvfhs services."""
    has = F.col("kind").isin("fhv", "hvfhs") & (F.col("has_shared_match_flag") | F.col("has_shared_request_flag"))
    return _flag_share(trips, "shared_trip", has, "shared_trip")


def provider_share(trips: DataFrame) -> DataFrame:
    """provider -> trips, share of all hvfhs trips with a provider."""
    names = F.create_map(*[F.lit(x) for kv in PROVIDER_NAMES.items() for x in kv])
    hv = trips.filter((F.col("kind") == "hvfhs") & F.col("provider_code").isNotNull())
    named = hv.select(F.coalesce(names[F.col("provider_code")], F.col("provider_code")).alias("provider"))
    counts = named.groupBy("provider").agg(F.count(F.lit(1)).alias("trips"))
    return share_of_total(counts, "trips")


def pickup_counts(trips: DataFrame) -> DataFrame:
    """service, year, PULocationID -> trips."""
    valid = trips.filter(F.col("PULocationID").isNotNull())
    return valid.groupBy("service", "year", F.col("PULocationID").cast("int").alias("PULocationID")).agg(
        F.count(F.lit(1)).alias("trips")
    )


def od_counts(trips: DataFrame) -> DataFrame:
    """service, year, PULocationID, DOLocationID -> trips."""
    valid = trips.filter(F.col("PULocationID").isNotNull() & F.col("DOLocationID").isNotNull())
    return valid.groupBy(
        "service",
        "year",
        F.col("PULocationID").cast("int").alias("PULocationID"),
        F.col("DOLocationID").cast("int").alias("DOLocationID"),
    ).agg(F.count(F.lit(1)).alias("trips"))


def with_zone(df: DataFrame, zones: DataFrame, key: str, borough_col: str = "Borough", zone_col: str = "Zone") -> DataFrame:
    """Left join a zone lookup (LocationID, Borough, Zone); misses become 'Unknown' (J1).

    The lookup is not hinted: the optimizer broadcasts it when its measured
    size is under ``spark.sql.autoBroadcastJoinThreshold`` and shuffles
    otherwise.
    """
    z = zones.select(
        F.col("LocationID").cast("int").alias(key),
        F.col("Borough").alias(borough_col),
        F.col("Zone").alias(zone_col),
    )
    out = df.join(z, on=key, how="left")
    return out.fillna("Unknown", subset=[borough_col, zone_col])


def borough_share(trips: DataFrame, zones: DataFrame) -> DataFrame:
    """service, Borough -> trips, share within service.

    Rows with no pickup zone id are excluded (they have no pickup count);
    ids missing from the lookup count as 'Unknown'.
    """
    pu = pickup_counts(trips).groupBy("service", "PULocationID").agg(F.sum("trips").alias("trips"))
    named = with_zone(pu, zones, "PULocationID")
    per_borough = named.groupBy("service", "Borough").agg(F.sum("trips").alias("trips"))
    return share_within(per_borough, "service", "trips")


def top_pickup_zones(trips: DataFrame, zones: DataFrame, k: int = TOP_ZONES) -> DataFrame:
    """Top-k pickup zones per service in the service's latest year.

    Ranked per service and year (a partial limit before the shuffle), then cut
    to the latest year: only k rows per service and year meet in the second
    window, only k per service are joined.  Ties on trips are broken by zone id.
    """
    ranked = top_k_per_group(pickup_counts(trips), ["service", "year"], [F.col("trips").desc(), F.col("PULocationID").asc()], k)
    top = latest_per_group(ranked, "service", "year")
    return with_zone(top, zones, "PULocationID")


def top_od_pairs(trips: DataFrame, zones: DataFrame, k: int = TOP_PAIRS) -> DataFrame:
    """Top-k origin-destination pairs per service in its latest year."""
    order = [F.col("trips").desc(), F.col("PULocationID").asc(), F.col("DOLocationID").asc()]
    top = latest_per_group(top_k_per_group(od_counts(trips), ["service", "year"], order, k), "service", "year")
    named = with_zone(top, zones, "PULocationID", "OriginBorough", "OriginZone")
    return with_zone(named, zones, "DOLocationID", "DestBorough", "DestZone")


def top_zones_with_fallback(trips: DataFrame, k: int) -> DataFrame:
    """Top-k pickup zones of the latest year, or of all years when the latest
    year has too few zones (W7)."""
    items = pickup_counts(trips)
    return top_k_with_fallback(
        items, "service", "year", [F.col("trips").desc(), F.col("year").desc(), F.col("PULocationID").asc()], k
    )
