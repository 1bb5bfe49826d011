"""Edge cases of the column helpers (bin edges, blank tokens, bad dates, units)."""

import datetime as dt

from pyspark.sql import functions as F

from citybeat.constants import BIKE_DURATION_EDGES, BIKE_DURATION_LABELS, DISTANCE_EDGES, DISTANCE_LABELS
from citybeat.functions import (
    compact_digits_to_timestamp,
    corridor_label,
    epoch_to_timestamp,
    left_closed_bin,
    normalize_borough,
    normalize_direction,
    parse_mixed_timestamp,
    right_closed_bin,
    round_half_even,
    round_half_up,
    valid_calendar_date,
)


def test_left_closed_bins_on_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.5, 1.0, 2.0, 5.0, 19.999, 20.0, 9999.0, 10000.0, -1.0]], "v double")
    got = [r.b for r in df.select(left_closed_bin("v", DISTANCE_EDGES, DISTANCE_LABELS).alias("b")).collect()]
    assert got == ["0-1", "0-1", "1-2", "2-5", "5-10", "10-20", "20+", "20+", None, None]


def test_right_closed_bins_lowest_included(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 5.0, 5.001, 10.0, 40.0, 40.5, 360.0]], "v double")
    b = right_closed_bin("v", BIKE_DURATION_EDGES, BIKE_DURATION_LABELS)
    got = [r.b for r in df.select(b.alias("b")).collect()]
    assert got == ["0-5 min", "0-5 min", "5-10 min", "5-10 min", "20-40 min", "40+ min", "40+ min"]


def test_blank_tokens_and_bad_dates_parse_to_null(spark):
    vals = ["", "NaT", "nan", "None", "  ", "2024-02-30 10:00:00", "2024-01-02 03:04:05", "01/02/2024 03:04", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.t for r in df.select(parse_mixed_timestamp("s").cast("timestamp_ntz").alias("t")).collect()]
    assert got[:6] == [None] * 6
    assert got[6] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[7] == dt.datetime(2024, 1, 2, 3, 4)
    assert got[8] is None


def test_epoch_units_by_magnitude(spark):
    micros = 1_704_164_645_123_456  # 2024-01-02 03:04:05.123456 UTC
    vals = [micros // 1_000_000, micros // 1000, micros, micros * 1000]
    df = spark.createDataFrame([(v,) for v in vals], "v long")
    got = [r.t for r in df.select(epoch_to_timestamp("v").cast("timestamp_ntz").alias("t")).collect()]
    assert got[0] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert got[1] == dt.datetime(2024, 1, 2, 3, 4, 5, 123000)
    assert got[2] == got[3] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)


def test_compact_digits(spark):
    df = spark.createDataFrame([("20240131235959",), ("202401312359",), ("20240131",), ("20240230",), ("2024013",)], "s string")
    got = [r.t for r in df.select(compact_digits_to_timestamp("s").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 31, 23, 59, 59), dt.datetime(2024, 1, 31, 23, 59), dt.datetime(2024, 1, 31), None, None]


def test_direction_borough_corridor(spark):
    df = spark.createDataFrame(
        [(" nb ", "  BRONX ", "A St", "", None), ("", "staten island", " ", " ", " "), (None, "x", None, None, None)],
        "d string, b string, s string, f string, t string",
    )
    rows = df.select(
        normalize_direction("d").alias("d"),
        normalize_direction("d", parity=True).alias("dp"),
        normalize_borough("b").alias("b"),
        corridor_label(["s", "f", "t"]).alias("c"),
    ).collect()
    assert [r.d for r in rows] == ["NB", "UNK", "UNK"]
    assert [r.dp for r in rows] == ["NB", "UNK", "NAN"]
    assert [r.b for r in rows] == ["Bronx", "Staten Island", "X"]
    assert [r.c for r in rows] == ["A St", "Unknown", "Unknown"]


def test_invalid_calendar_dates(spark):
    df = spark.createDataFrame([(2024, 2, 30), (2023, 2, 29), (2024, 2, 29), (2024, 13, 1)], "y int, m int, d int")
    got = [r.t for r in df.select(valid_calendar_date("y", "m", "d").alias("t")).collect()]
    assert [g is not None for g in got] == [False, False, True, False]


def test_rounding_matches_python(spark):
    vals = [0.125, 0.135, 2.675, 1.005, 0.5, 1.5, 2.5, 0.1 + 0.2, 12345.67895]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    got = [r.r for r in df.select(round_half_even(F.col("v"), 2).alias("r")).collect()]
    assert got == [round(v * 100) / 100 for v in vals]
    up = [r.r for r in df.select(round_half_up(F.col("v"), 0).alias("r")).collect()]
    assert up[4:7] == [1.0, 2.0, 3.0]


def test_offsets_convert_to_utc(spark):
    df = spark.createDataFrame([("2024-01-02T03:04:05+02:00",), ("2024-01-02 03:04:05Z",)], "s string")
    got = [r.t for r in df.select(parse_mixed_timestamp("s").cast("timestamp_ntz").alias("t")).collect()]
    assert got == [dt.datetime(2024, 1, 2, 1, 4, 5), dt.datetime(2024, 1, 2, 3, 4, 5)]


def test_mixed_date_shapes(spark):
    at = dt.datetime
    cases = {
        "2024-01-05T10:11": at(2024, 1, 5, 10, 11), "2024-01-05T10:11Z": at(2024, 1, 5, 10, 11), "2024-01-05 10:11+01:00": at(2024, 1, 5, 9, 11),
        "2024-01-05 10:11:12.123456789": at(2024, 1, 5, 10, 11, 12, 123456), "2024-01-05T10:11:12+0200": at(2024, 1, 5, 8, 11, 12),
        "2024-01-05 10:11:12 +02:00": at(2024, 1, 5, 8, 11, 12), "2024-01-05 10:11:12 UTC": at(2024, 1, 5, 10, 11, 12),
        "2024/01/05 10:11:12": at(2024, 1, 5, 10, 11, 12), "2024/1/5": at(2024, 1, 5), "20240105": at(2024, 1, 5),
        "20240105101112": at(2024, 1, 5, 10, 11, 12), "202401051011": at(2024, 1, 5, 10, 11), "20240105T101112": at(2024, 1, 5, 10, 11, 12),
        "Jan 5, 2024 10:11": at(2024, 1, 5, 10, 11), "January 5 2024": at(2024, 1, 5), "5 Jan 2024 3:04 pm": at(2024, 1, 5, 15, 4),
        "Fri, 05-Jan-2024 10:11:12": at(2024, 1, 5, 10, 11, 12), "1/2/24 3:04": at(2024, 1, 2, 3, 4), "1/2/70": at(1970, 1, 2),
        "1/2/2024 12:04:05 AM": at(2024, 1, 2, 0, 4, 5), "01/02/2024 12:04 PM": at(2024, 1, 2, 12, 4), "2024-1-5 3:04": at(2024, 1, 5, 3, 4),
        "  2024-01-05 10:11:12  ": at(2024, 1, 5, 10, 11, 12), "2024-01-05 10:11:12.5": at(2024, 1, 5, 10, 11, 12, 500000),
        "13/40/2024": None, "2024-02-30": None, "Foo 5, 2024": None, "20241305": None, "2024-01-05 25:00": None, "10:11:12": None,
        "2024": None, "2024-01-05 10:11 xx": None, "1/2/2024 13:04 PM": None, "20240105101": None, "abc": None, "5": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string")
    got = {r.s: r.t for r in df.select("s", parse_mixed_timestamp("s").cast("timestamp_ntz").alias("t")).collect()}
    assert got == cases


def test_missing_coordinates_drop_the_trip(spark):
    from citybeat.operators.bikes import clean_trips

    rows = [(v, w) for v, w in [("1.5", "2"), ("nan", "2"), ("1", "NaN"), ("abc", "2"), (None, "2"), ("", "2")]]
    df = spark.createDataFrame(
        [("2024-01-01 10:00", "2024-01-01 10:10", "a", "b", v, w, "1", "1") for v, w in rows],
        "started_at string, ended_at string, start_station_id string, end_station_id string, start_lat string, start_lng string, "
        "end_lat string, end_lng string",
    )
    got = [(r.start_lat, r.start_lng) for r in clean_trips(df).collect()]
    assert sorted(got, key=str) == [(1.5, 2.0), (None, 2.0)]
