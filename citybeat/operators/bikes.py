"""Bike-share trip cleaning and aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citybeat.constants import BIKE_DURATION_EDGES, BIKE_DURATION_LABELS, BIKE_DURATION_RANGE, BLANK_TOKENS, TOP_FLOWS, TOP_STATIONS
from citybeat.functions.bins import right_closed_bin
from citybeat.functions.datetime import minutes_between, parse_mixed_timestamp
from citybeat.functions.numeric import exact_sum, round_half_up, to_double
from citybeat.operators.common import share_of_total, top_k, zero_filled_counts

REQUIRED = [
    "started_at", "ended_at", "start_station_id", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng",
]


def clean_trips(raw: DataFrame, formats: Sequence[str] | None = None) -> DataFrame:
    """Raw bike rows (strings) -> typed trips with ``duration_min``.

    Rows missing a required field (null or one of ``BLANK_TOKENS``, in any case)
    are dropped, start/end are parsed from any supported format, coordinates
    that are no numbers become null, and only durations in [0, 360] minutes are
    kept.  Timestamps come out as UTC wall-clock
    ``timestamp_ntz``.
    """
    missing = [t.lower() for t in BLANK_TOKENS]
    there = F.lit(True)
    for c in REQUIRED:
        there = there & F.coalesce(~F.lower(F.trim(F.col(c).cast("string"))).isin(missing), F.lit(False))
    kept = raw.filter(there)
    parse = (lambda c: parse_mixed_timestamp(c, formats)) if formats else parse_mixed_timestamp
    # a generator's columns are computed once; plain ones would be parsed again in the filter and in every aggregate
    times = F.inline(F.array(F.struct(parse("started_at").alias("started_at"), parse("ended_at").alias("ended_at"))))
    typed = kept.select(*[c for c in kept.columns if c not in ("started_at", "ended_at")], times).select(*kept.columns)
    typed = typed.withColumns(
        {
            "start_station_id": F.col("start_station_id").cast("string"),
            "end_station_id": F.col("end_station_id").cast("string"),
            **{c: to_double(c) for c in ("start_lat", "start_lng", "end_lat", "end_lng")},
        }
    )
    typed = typed.withColumn("duration_min", minutes_between("started_at", "ended_at"))
    lo, hi = BIKE_DURATION_RANGE
    typed = typed.filter(F.col("duration_min").between(lo, hi))
    return typed.withColumns(
        {"started_at": F.col("started_at").cast("timestamp_ntz"), "ended_at": F.col("ended_at").cast("timestamp_ntz")}
    )


def first_non_null(col: str, order: Column) -> Column:
    """Value of ``col`` on the earliest row (by ``order``) where it is not null.

    Replaces order-dependent ``first``: nulls get no ordering key, and
    ``min_by`` ignores rows whose key is null.
    """
    return F.min_by(F.col(col), F.when(F.col(col).isNotNull(), order))


def station_flows(trips: DataFrame, order: Column | None = None) -> DataFrame:
    """(start, end) station pair -> trip_count, avg_duration_min and the
    first non-null station names and coordinates (A13)."""
    order = order if order is not None else F.col("ride_key")
    agg = trips.groupBy("start_station_id", "end_station_id").agg(
        first_non_null("start_station_name", order).alias("start_station_name"),
        first_non_null("start_lat", order).alias("start_lat"),
        first_non_null("start_lng", order).alias("start_lng"),
        first_non_null("end_station_name", order).alias("end_station_name"),
        first_non_null("end_lat", order).alias("end_lat"),
        first_non_null("end_lng", order).alias("end_lng"),
        F.count("ride_id").alias("trip_count"),
        exact_sum("duration_min").cast("double").alias("__dsum"),
    )
    avg = F.when(F.col("trip_count") > 0, F.col("__dsum") / F.col("trip_count")).otherwise(F.lit(0.0))
    return agg.withColumn("avg_duration_min", round_half_up(avg, 2)).drop("__dsum")


def top_flows(trips: DataFrame, k: int = TOP_FLOWS) -> DataFrame:
    """Busiest k station pairs; ties broken by station ids."""
    flows = station_flows(trips)
    return top_k(flows, [F.col("trip_count").desc(), F.col("start_station_id"), F.col("end_station_id")], k)


def top_start_stations(trips: DataFrame, k: int = TOP_STATIONS) -> DataFrame:
    """Busiest k start stations with first non-null name and coordinates."""
    order = F.col("ride_key")
    stations = trips.groupBy(F.col("start_station_id").alias("station_id")).agg(
        first_non_null("start_station_name", order).alias("station_name"),
        first_non_null("start_lat", order).alias("lat"),
        first_non_null("start_lng", order).alias("lng"),
        F.count("ride_id").alias("trip_count"),
    )
    return top_k(stations, [F.col("trip_count").desc(), F.col("station_id")], k)


def hourly_by_user(trips: DataFrame) -> DataFrame:
    """hour, member_casual -> trip_count (A15); null member types are not grouped."""
    return (
        trips.filter(F.col("member_casual").isNotNull())
        .groupBy(F.hour("started_at").alias("hour"), "member_casual")
        .agg(F.count("ride_id").alias("trip_count"))
    )


def weekday_by_user(trips: DataFrame) -> DataFrame:
    """weekday_index (Mon=0), member_casual -> trip_count."""
    return (
        trips.filter(F.col("member_casual").isNotNull())
        .groupBy(F.weekday("started_at").alias("weekday_index"), "member_casual")
        .agg(F.count("ride_id").alias("trip_count"))
    )


def rideable_type_share(trips: DataFrame) -> DataFrame:
    """rideable_type -> trip_count and share of all counted trips."""
    counts = (
        trips.filter(F.col("rideable_type").isNotNull())
        .groupBy("rideable_type")
        .agg(F.count("ride_id").alias("trip_count"))
    )
    return share_of_total(counts, "trip_count", zero_total_as=0.0)


def member_share(trips: DataFrame) -> DataFrame:
    """member_casual -> trip_count and share."""
    counts = (
        trips.filter(F.col("member_casual").isNotNull())
        .groupBy("member_casual")
        .agg(F.count("ride_id").alias("trip_count"))
    )
    return share_of_total(counts, "trip_count", zero_total_as=0.0)


def duration_bins(trips: DataFrame) -> DataFrame:
    """duration_bin x member_casual -> trip_count, all bins for every seen member type."""
    label = right_closed_bin("duration_min", BIKE_DURATION_EDGES, BIKE_DURATION_LABELS, include_lowest=True)
    valid = trips.filter(F.col("member_casual").isNotNull())
    counted = F.when(F.col("ride_id").isNotNull(), F.lit(1)).otherwise(F.lit(0))
    return zero_filled_counts(valid, "member_casual", label, BIKE_DURATION_LABELS, "duration_bin", "trip_count", weight=counted)


def duration_member_pivot(trips: DataFrame, members: Sequence[str] = ("member", "casual")) -> DataFrame:
    """duration_bin rows x one column per member type, zero filled (R2)."""
    long = duration_bins(trips)
    wide = long.groupBy("duration_bin").pivot("member_casual", list(members)).agg(F.sum("trip_count"))
    return wide.fillna(0, subset=list(members))


def route_candidates(flows: DataFrame) -> DataFrame:
    """Flow rows usable as route candidates: parsable numbers, no self loops."""
    typed = flows.withColumns(
        {
            c: F.col(c).try_cast("double")
            for c in ["start_lat", "start_lng", "end_lat", "end_lng"]
        }
    ).withColumn("trip_count", F.col("trip_count").try_cast("double").try_cast("long"))
    ok = F.lit(True)
    for c in ["start_lat", "start_lng", "end_lat", "end_lng", "trip_count"]:
        ok = ok & F.col(c).isNotNull()
    return typed.filter(ok & ~F.col("start_station_id").eqNullSafe(F.col("end_station_id")))
