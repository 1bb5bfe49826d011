"""Driver tables re-dressed as the reference's inputs.

The reference reads taxi Parquet, bike and traffic CSVs, ridership CSVs,
report sheets, GeoJSON points and road graphs.  The driver provides
TPC-H-like tables instead; these functions derive the same shapes from them
with plain column expressions (no data is generated on the driver), so every
query's work grows with the tables.

Notation: L=lineitem, O=orders, C=customer, S=supplier, N=nation, R=region,
E=events.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from citybeat.plans.tables import table  # noqa: F401  (re-exported)
from citybeat.session import ensure_checkpoint_dir
from citybeat.sources.trips import normalize_trips

# Years kept by the trip queries (P5): the tables span 1995-2001.
TRIP_YEARS = (1996, 2000)

TRIP_FIELDS = [
    "pickup_datetime", "trip_distance", "trip_time", "base_fare", "tip_amount", "tolls_amount",
    "extra", "mta_tax", "airport_fee", "ratecode", "PULocationID", "DOLocationID", "shared_match_flag",
]


def service_kind(service: F.Column) -> F.Column:
    """Service letter -> service kind: A behaves like fhv, R like hvfhs, N like yellow."""
    return F.when(service == "A", "fhv").when(service == "R", "hvfhs").otherwise("yellow")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L as one taxi file group with source-style column names.

    service=l_returnflag, pickup=l_shipdate, trip_time=l_quantity minutes,
    distance=l_extendedprice/5000 miles, fare=l_extendedprice,
    tip=fare*l_discount, tolls null where l_discount=0, airport_fee=l_tax-0.07
    (not a number for line 5), extra=l_quantity/10 (not a number for line 6),
    RatecodeID=l_linenumber, PU=l_suppkey (line 4: its negative, in no zone), DO=l_partkey mod 100.
    """
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_returnflag").alias("service"),
        F.col("l_shipdate").alias("pickup_datetime"),
        (F.col("l_quantity") * 60).alias("trip_time"),
        (F.col("l_extendedprice") / 5000.0).alias("trip_distance"),
        F.col("l_extendedprice").alias("fare_amount"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tip_amount"),
        F.when(F.col("l_discount") != 0, F.col("l_quantity") * F.col("l_discount")).alias("tolls_amount"),
        F.when(F.col("l_linenumber") == 6, F.lit(float("nan"))).otherwise(F.col("l_quantity") / 10.0).alias("extra"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("mta_tax"),
        F.when(F.col("l_linenumber") == 5, F.lit(float("nan"))).otherwise(F.col("l_tax") - 0.07).alias("airport_fee"),
        F.col("l_linenumber").alias("RatecodeID"),
        F.when(F.col("l_linenumber") == 4, -F.col("l_suppkey")).otherwise(F.col("l_suppkey")).alias("PULocationID"),
        (F.col("l_partkey") % 100).alias("DOLocationID"),
        F.when(F.col("l_discount") == 0, F.lit(None).cast("string"))
        .when(F.col("l_linestatus") == "O", F.lit(" y"))
        .otherwise(F.lit("1"))
        .alias("shared_match_flag"),
        F.col("l_orderkey"),
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical trips from L (one file group, service from the row)."""
    raw = raw_trips(spark, sf_dir)
    service = F.col("service")
    return normalize_trips(raw, service, service_kind(service), TRIP_FIELDS, *TRIP_YEARS)


def trips_with_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical trips with a provider code: L joined to O on the order key.

    provider = 'HV000' + first digit of o_orderpriority; '1-URGENT' gives
    HV0001, which has no provider name and is reported under its code.
    """
    raw = raw_trips(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"),
        F.concat(F.lit("HV000"), F.substring("o_orderpriority", 1, 1)).alias("hvfhs_license_num"),
    )
    joined = raw.join(orders, on="l_orderkey")
    service = F.col("service")
    return normalize_trips(joined, service, service_kind(service), TRIP_FIELDS + ["provider"], *TRIP_YEARS)


def event_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E as a trip file group: service=event_type, pickup=ts, distance=value miles."""
    ev = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("service"),
        F.col("ts").alias("tpep_pickup_datetime"),
        F.col("value").alias("trip_distance"),
    )
    return normalize_trips(ev, F.col("service"), F.lit("yellow"), ["pickup_datetime", "trip_distance"], 2024, 2024)


def trip_folders(spark: SparkSession, sf_dir: str) -> str:
    """L landed as Parquet files under ``<year>/fhvhv/`` in two column layouts.

    Up to 1997: lpep pickup and drop-off times, trip_miles, request flag
    only.  From 1998: pickup time, trip_time in seconds, match flag.
    """
    from citybeat.session import scratch_path

    root = scratch_path(spark, "trips")
    li = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    flag = F.when(F.col("l_linestatus") == "O", F.lit(" y")).when(F.col("l_discount") > 0, F.lit("N"))
    minutes = F.make_dt_interval(F.lit(0), F.lit(0), F.col("l_quantity").cast("int"))
    old = [
        F.col("l_shipdate").alias("lpep_pickup_datetime"), (F.col("l_shipdate") + minutes).alias("lpep_dropoff_datetime"),
        (F.col("l_extendedprice") / 5000.0).alias("trip_miles"), flag.alias("shared_request_flag"),
    ]
    new = [
        F.col("l_shipdate").alias("pickup_datetime"), (F.col("l_quantity") * 60).alias("trip_time"),
        (F.col("l_extendedprice") / 5000.0).alias("trip_distance"), flag.alias("shared_match_flag"),
    ]
    for year in range(TRIP_YEARS[0], TRIP_YEARS[1] + 1):
        rows = li.filter(F.col("year") == year).select(*(old if year <= 1997 else new))
        rows.write.parquet(f"{root}/{year}/fhvhv")
    return root


def folder_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed folders discovered, read per column layout and combined."""
    from citybeat.sources.trips import available_years, normalize_file_groups, read_file_groups, select_years, year_partition_paths

    root = trip_folders(spark, sf_dir)
    years = select_years(available_years(spark, root), *TRIP_YEARS)
    groups = read_file_groups(spark, year_partition_paths(root, years, "fhvhv"))
    fields = ["pickup_datetime", "dropoff_datetime", "trip_distance", "trip_time", "shared_match_flag", "shared_request_flag"]
    return normalize_file_groups(groups, "fhvhv", "hvfhs", fields, *TRIP_YEARS)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup: LocationID=s_suppkey, Borough=r_name, Zone=n_name.

    Every supplier is a zone; the pickup ids that miss the lookup and report
    as 'Unknown' come from the trips.
    """
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (
        s.join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(F.col("s_suppkey").alias("LocationID"), F.col("r_name").alias("Borough"), F.col("n_name").alias("Zone"))
    )


# --- bikes ------------------------------------------------------------------

# How the raw rows write their start: padded and unpadded, 24 and 12 hours.
BIKE_FORMATS = (
    "yyyy-MM-dd HH:mm:ss", "MM/dd/yyyy HH:mm", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "M/d/yyyy H:mm", "MM/dd/yyyy hh:mm:ss a",
)


def raw_bike_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E as a raw bike-trip CSV (all strings, dirty on purpose).

    started_at is written in one of five formats (event_id mod 5) with
    blank tokens injected; ended_at = ts + value minutes; stations are
    user_id mod 40 (end: (7*user_id + event_id) mod 40) with some names
    missing; ride_id is missing for values under 1; member type from
    user_id mod 4 = 0, unknown for user_id mod 13 = 0.
    """
    ev = table(spark, sf_dir, "events")
    ts = F.col("ts")
    start_str = (
        F.when(F.col("event_id") % 17 == 0, F.lit(""))
        .when(F.col("event_id") % 19 == 0, F.lit("NaT"))
        .when(F.col("event_id") % 5 == 0, F.date_format(ts, BIKE_FORMATS[0]))
        .when(F.col("event_id") % 5 == 1, F.date_format(ts, BIKE_FORMATS[1]))
        .when(F.col("event_id") % 5 == 2, F.date_format(ts, BIKE_FORMATS[2]))
        .when(F.col("event_id") % 5 == 3, F.date_format(ts, BIKE_FORMATS[3]))
        .otherwise(F.date_format(ts, BIKE_FORMATS[4]))
    )
    end_ts = F.timestamp_micros(F.unix_micros(ts.cast("timestamp")) + F.floor(F.col("value") * 60_000_000.0))
    s_id = F.col("user_id") % 40
    e_id = (F.col("user_id") * 7 + F.col("event_id")) % 40
    return ev.select(
        F.when(F.col("value") >= 1, F.concat(F.lit("R"), F.col("event_id").cast("string"))).alias("ride_id"),
        F.col("event_type").alias("rideable_type"),
        start_str.alias("started_at"),
        F.date_format(end_ts, BIKE_FORMATS[0]).alias("ended_at"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("Station "), s_id.cast("string"))).alias("start_station_name"),
        F.when(F.col("event_id") % 23 != 0, s_id.cast("string")).alias("start_station_id"),
        F.when(F.col("event_id") % 7 != 0, F.concat(F.lit("Station "), e_id.cast("string"))).alias("end_station_name"),
        e_id.cast("string").alias("end_station_id"),
        (F.lit(40.60) + s_id * 0.005).cast("string").alias("start_lat"),
        (F.lit(-74.05) + s_id * 0.004).cast("string").alias("start_lng"),
        (F.lit(40.60) + e_id * 0.005).cast("string").alias("end_lat"),
        (F.lit(-74.05) + e_id * 0.004).cast("string").alias("end_lng"),
        F.when(F.col("user_id") % 13 == 0, F.lit(None).cast("string"))
        .when(F.col("user_id") % 4 == 0, F.lit("member"))
        .otherwise(F.lit("casual"))
        .alias("member_casual"),
    )


BIKE_CSV_SCHEMA = (
    "ride_id string, rideable_type string, started_at string, ended_at string, start_station_name string, "
    "start_station_id string, end_station_name string, end_station_id string, start_lat string, start_lng string, "
    "end_lat string, end_lng string, member_casual string"
)

_LANDED: dict[tuple[str, str, str], str] = {}


def landed(spark: SparkSession, sf_dir: str, name: str, build, fmt: str = "parquet") -> str:
    """Path of a derived input table written once per application under the
    shared checkpoint folder (it stands for the raw files the reference reads)."""
    from citybeat.session import scratch_path

    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _LANDED:
        path = scratch_path(spark, name)
        writer = build(spark, sf_dir).write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.parquet(path)
        _LANDED[key] = path
    return _LANDED[key]


def bike_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw bike rows as CSV files, read back with an all-string schema (S3)."""
    from citybeat.sources.files import read_csv

    return read_csv(spark, landed(spark, sf_dir, "bike-csv", raw_bike_rows, "csv"), BIKE_CSV_SCHEMA)


def bike_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    from citybeat.operators.bikes import clean_trips

    return clean_trips(bike_csv(spark, sf_dir))


def nation_flow_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L as bike trips between nations: start = customer nation, end = supplier nation.

    ride_key orders rows for 'first non-null' (order key, line number);
    duration = l_quantity minutes; coordinates derived from the nation key.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    start_n = n.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("start_station_name"))
    end_n = n.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("end_station_name"))
    t = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(c, F.col("o_custkey") == c.c_custkey)
        .join(s, F.col("l_suppkey") == s.s_suppkey)
        .join(start_n, "c_nationkey", "left")
        .join(end_n, "s_nationkey", "left")
    )
    return t.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("ride_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ride_key"),
        F.col("o_orderdate").alias("started_at"),
        F.col("l_quantity").alias("duration_min"),
        F.col("c_nationkey").cast("string").alias("start_station_id"),
        "start_station_name",
        (F.lit(40.5) + F.col("c_nationkey") * 0.01).alias("start_lat"),
        (F.lit(-74.1) + F.col("c_nationkey") * 0.007).alias("start_lng"),
        F.col("s_nationkey").cast("string").alias("end_station_id"),
        "end_station_name",
        (F.lit(40.5) + F.col("s_nationkey") * 0.01).alias("end_lat"),
        (F.lit(-74.1) + F.col("s_nationkey") * 0.007).alias("end_lng"),
    )


# --- traffic counts -----------------------------------------------------------


def raw_traffic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E joined to R as automated traffic counts.

    Boro = region name of user_id mod 5 with messy case and padding; Yr/M/D/HH
    from ts, with impossible Feb 30 dates (event_id mod 29 = 0) and missing
    years (event_id mod 31 = 0); Vol = floor(value), negative for a third of
    'error' rows; Direction from event_type with blanks and nulls; street
    parts from user_id.
    """
    ev = table(spark, sf_dir, "events")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    ev = ev.join(region, (ev.user_id % 5) == region.r_regionkey, "left")
    boro = F.when(F.col("event_id") % 2 == 0, F.lower("r_name")).otherwise(F.concat(F.lit("  "), F.col("r_name"), F.lit(" ")))
    feb30 = F.col("event_id") % 29 == 0
    vol = F.floor("value").cast("int")
    direction = (
        F.when(F.col("event_type") == "click", F.lit(" nb"))
        .when(F.col("event_type") == "view", F.lit("SB "))
        .when(F.col("event_type") == "purchase", F.lit(""))
        .when(F.col("event_type") == "error", F.lit("eb"))
        .otherwise(F.lit(None).cast("string"))
    )
    return ev.select(
        boro.alias("Boro"),
        F.when(F.col("event_id") % 31 != 0, F.year("ts")).alias("Yr"),
        F.when(feb30, F.lit(2)).otherwise(F.month("ts")).alias("M"),
        F.when(feb30, F.lit(30)).otherwise(F.dayofmonth("ts")).alias("D"),
        F.hour("ts").alias("HH"),
        F.when((F.col("event_type") == "error") & (F.col("event_id") % 3 == 0), -vol - 1).otherwise(vol).alias("Vol"),
        F.concat(F.lit("Street "), (F.col("user_id") % 17).cast("string")).alias("street"),
        F.when(F.col("user_id") % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("Ave "), (F.col("user_id") % 5).cast("string"))).alias("fromSt"),
        F.when(F.col("user_id") % 7 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" Blvd "), (F.col("user_id") % 4).cast("string"), F.lit(" ")))
        .alias("toSt"),
        direction.alias("Direction"),
    )


# Borough order of the weekday/weekend chart: the region names as boroughs,
# plus one borough that never has counts.
BOROUGH_ORDER = ["Africa", "America", "Asia", "Europe", "Middle East", "Antarctica"]


def traffic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from citybeat.operators.traffic import clean_counts

    return clean_counts(raw_traffic_counts(spark, sf_dir))


# --- ridership ----------------------------------------------------------------

# Modes known to the mode charts; '5-LOW' plays an unknown mode.
KNOWN_MODES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


def ridership_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O as ridership rows: mode=o_orderpriority, year of o_orderdate,
    ridership=o_totalprice.  Every order is kept; the 1996 '5-LOW' orders are
    reported under '4-NOT SPECIFIED', so the year x mode grid has a hole to
    fill."""
    o = table(spark, sf_dir, "orders")
    year = F.year("o_orderdate")
    mode = F.when((F.col("o_orderpriority") == "5-LOW") & (year == 1996), F.lit("4-NOT SPECIFIED")).otherwise(
        F.col("o_orderpriority")
    )
    return o.select(mode.alias("mode"), year.alias("year"), F.col("o_totalprice").alias("ridership"))


# --- timestamps as numbers and digit strings ------------------------------------


def epoch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E.ts written as epoch seconds / ms / us / ns (event_id mod 4) and as
    14, 12 or 8 digit strings (event_id mod 3)."""
    ev = table(spark, sf_dir, "events")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    unit = F.col("event_id") % 4
    value = (
        F.when(unit == 0, F.floor(micros / F.lit(1_000_000)))
        .when(unit == 1, F.floor(micros / F.lit(1000)))
        .when(unit == 2, micros)
        .otherwise(micros * 1000)
    )
    fmt = F.col("event_id") % 3
    digits = (
        F.when(fmt == 0, F.date_format("ts", "yyyyMMddHHmmss"))
        .when(fmt == 1, F.date_format("ts", "yyyyMMddHHmm"))
        .otherwise(F.date_format("ts", "yyyyMMdd"))
    )
    return ev.select("event_id", value.cast("long").alias("epoch_value"), digits.alias("digits"))


# --- trips whose latest year is thin ------------------------------------------------


def thin_year_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trips, those of service R in its latest year from a hundred zones only."""
    thin = (F.col("service") == "R") & (F.col("year") == TRIP_YEARS[1])
    zone = F.when(thin, F.pmod("PULocationID", F.lit(100))).otherwise(F.col("PULocationID"))
    return trips(spark, sf_dir).withColumn("PULocationID", zone)


# --- spatial --------------------------------------------------------------------

# Fixed ring shapes in thousandths of a zone's size: a square, a triangle and a concave L.
ZONE_SHAPES = [
    [(0, 0), (1000, 0), (1000, 1000), (0, 1000), (0, 0)],
    [(0, 0), (1300, 100), (700, 1200), (0, 0)],
    [(0, 0), (900, 0), (900, 300), (400, 300), (400, 1100), (0, 1100), (0, 0)],
]


def _place(key: str, a: int, b: int) -> list[F.Column]:
    """A position of its own for every key on a plane of about a million units a side."""
    return [(F.col(key) * a % 1000003).alias("x"), (F.col(key) * b % 999983).alias("y")]


def customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C as points; no two customers share a position."""
    return table(spark, sf_dir, "customer").select("c_custkey", *_place("c_custkey", 7919, 104729))


def supplier_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S as points; no two suppliers share a position."""
    return table(spark, sf_dir, "supplier").select("s_suppkey", *_place("s_suppkey", 7907, 104723))


def zone_size(spark: SparkSession, sf_dir: str) -> int:
    """Extent of a zone: shrinks as zones are added, so that about a third of the plane stays covered."""
    return int(600000 / math.sqrt(max(1, table(spark, sf_dir, "supplier").count())))


def zone_polygons(spark: SparkSession, sf_dir: str, size: int) -> DataFrame:
    """Every supplier's zone, a square, a triangle or an L at its place; the zones of a nation share one poly_id."""
    base = supplier_places(spark, sf_dir).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    shapes = F.array(*[F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in shape]) for shape in ZONE_SHAPES])
    at = lambda origin, v: F.col(origin) + F.floor(v * F.lit(size).cast("long") / 1000).cast("long")
    ring = F.transform(
        F.get(shapes, (F.col("s_suppkey") % 3).cast("int")), lambda p: F.struct(at("x", p["x"]).alias("x"), at("y", p["y"]).alias("y"))
    )
    return base.select(F.col("s_nationkey").alias("poly_id"), ring.alias("ring"))


def customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C as points on a 0..999 integer grid (tenths of a unit)."""
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", (F.col("c_custkey") * 37 % 1000).alias("x"), (F.col("c_custkey") * 91 % 1000).alias("y"))


def supplier_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S as points on the same grid."""
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", (F.col("s_suppkey") * 53 % 1000).alias("x"), (F.col("s_suppkey") * 29 % 1000).alias("y"))


def supplier_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S in degrees: lng = -74.05 + x/10000, lat = 40.6 + y/10000."""
    p = supplier_points(spark, sf_dir)
    return p.select("s_suppkey", (F.lit(-74.05) + F.col("x") / 10000.0).alias("lng"), (F.lit(40.6) + F.col("y") / 10000.0).alias("lat"))


def order_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's line items, in line-number order, as a path through supplier locations.

    Line numbers repeat within an order in these tables, so the sequence key
    is the struct (line number, supplier): rows that still tie are the same point.
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    geo = supplier_geo(spark, sf_dir)
    seq = F.struct("l_linenumber", "l_suppkey")
    return li.join(geo, li.l_suppkey == geo.s_suppkey).select(
        F.col("l_orderkey").alias("route_id"), seq.alias("seq"), "lng", "lat"
    )


# --- road network ------------------------------------------------------------------


def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S as road nodes with metre coordinates (20 m per grid step)."""
    p = supplier_points(spark, sf_dir)
    return p.select(F.col("s_suppkey").alias("node_id"), (F.col("x") * 20).alias("x"), (F.col("y") * 20).alias("y"))


def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Directed edges u -> (7u + k) mod n for k = 1, 2, 3, plus a longer
    parallel edge for k = 1; length = 200 + (31u + 17v) mod 800 metres."""
    s = table(spark, sf_dir, "supplier")
    n = s.agg(F.max("s_suppkey") + 1).scalar()
    ks = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(key).alias("key")) for k, key in [(1, 0), (1, 1), (2, 0), (3, 0)]])
    e = s.select(F.col("s_suppkey").alias("u"), F.explode(ks).alias("__k"))
    e = e.withColumn("v", (F.col("u") * 7 + F.col("__k.k")) % n)
    length = (F.lit(200) + (F.col("u") * 31 + F.col("v") * 17) % 800 + F.col("__k.key") * 50).cast("double")
    return e.select("u", "v", F.col("__k.key").alias("key"), length.alias("length"))


def graph_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources of the reachability job: every supplier."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("source"))


def customer_stops_m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C points in metres, used as transit stops for the allowed-node filter."""
    p = customer_points(spark, sf_dir)
    return p.select((F.col("x") * 20).alias("x"), (F.col("y") * 20).alias("y"))


# --- report sheets ----------------------------------------------------------------

TIME_WINDOWS = ["00-08", "08-16", "16-24"]


def report_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L rows as rejected-plate events: the file is the order priority and
    ship quarter (priority 5 files carry no quarter in the name), the sheet is
    the ship month, the reason the return flag and line status, the day the
    ship weekday, the time window from the line number, the borough the
    supplier's region and the community board l_partkey mod 12."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    t = (
        li.join(o, li.l_orderkey == o.o_orderkey)
        .join(s, li.l_suppkey == s.s_suppkey)
        .join(n, s.s_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
    )
    p = F.substring("o_orderpriority", 1, 1)
    yr = F.year("l_shipdate").cast("string")
    file = F.when(p == "5", F.concat(F.lit("rejects_p5_"), yr, F.lit(".xlsx"))).otherwise(
        F.concat(F.lit("rejects_p"), p, F.lit("_q"), F.quarter("l_shipdate").cast("string"), F.lit("-"), yr, F.lit(".xlsx"))
    )
    return t.select(
        file.alias("file"),
        F.date_format("l_shipdate", "MMMM").alias("sheet"),
        F.substring("o_orderpriority", 3, 100).alias("vio"),
        F.concat(F.lit("Reason "), F.col("l_returnflag"), F.col("l_linestatus")).alias("reason"),
        (F.dayofweek("l_shipdate") - 1).alias("d"),
        F.when(F.col("l_linenumber") <= 2, 0).when(F.col("l_linenumber") <= 4, 1).otherwise(2).alias("w"),
        F.col("r_regionkey").alias("b"),
        F.col("r_name"),
        (F.col("l_partkey") % 12).cast("int").alias("cb"),
    )


def report_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report sheets laid out as cells (file, sheet, row, col, value).

    Per sheet: two metadata rows, then the day/time block (day labels only
    above the first column of each day), the borough block and the
    community-board block, each ended by a blank row.  Reasons are numbered
    per sheet; one extra 'Reject Category Summary' sheet per file must be
    ignored by the reader.
    """
    from citybeat.constants import DAY_LABELS, HEADER_LABEL, SECTION_BOARD, SECTION_BOROUGH, SECTION_DAY

    ensure_checkpoint_dir(spark)
    base = report_base(spark, sf_dir)
    keys = ["file", "sheet"]
    # One pass over the joined rows: each row is counted once per section
    # (day x window, borough, board) by exploding its three section keys and
    # aggregating once; only this small aggregate is checkpointed.
    sections = F.array(
        F.struct(F.lit(0).alias("s"), F.col("d").alias("k1"), F.col("w").alias("k2"), F.lit(None).cast("string").alias("nm")),
        F.struct(F.lit(1).alias("s"), F.col("b").alias("k1"), F.lit(0).alias("k2"), F.col("r_name").alias("nm")),
        F.struct(F.lit(2).alias("s"), F.col("cb").alias("k1"), F.lit(0).alias("k2"), F.lit(None).cast("string").alias("nm")),
    )
    counts = (
        base.select(*keys, "vio", "reason", F.inline(sections))
        .groupBy(*keys, "vio", "reason", "s", "k1", "k2", "nm")
        .agg(F.count(F.lit(1)).alias("n"))
        .checkpoint()
    )
    reasons = counts.select(*keys, "vio", "reason").distinct()
    reasons = reasons.withColumn("ri", F.dense_rank().over(Window.partitionBy(*keys).orderBy("reason")) - 1).withColumn(
        "R", F.count(F.lit(1)).over(Window.partitionBy(*keys))
    ).checkpoint()
    sheets = reasons.select(*keys, "vio", "R").distinct()

    def cell(row, col, value):
        return F.struct(row.cast("int").alias("row"), col.cast("int").alias("col"), value.cast("string").alias("value"))

    fixed = [
        cell(F.lit(0), F.lit(0), F.concat(F.lit("VIO TYPE: "), F.col("vio"))),
        cell(F.lit(1), F.lit(0), F.concat(F.lit("MONTH: "), F.col("sheet"))),
        cell(F.lit(2), F.lit(0), F.lit(SECTION_DAY)),
        cell(F.lit(4), F.lit(0), F.lit(HEADER_LABEL)),
        cell(F.col("R") + 6, F.lit(0), F.lit(SECTION_BOROUGH)),
        cell(F.col("R") + 7, F.lit(0), F.lit(HEADER_LABEL)),
        cell(F.col("R") * 2 + 9, F.lit(0), F.lit(SECTION_BOARD)),
        cell(F.col("R") * 2 + 10, F.lit(0), F.lit(HEADER_LABEL)),
    ]
    day_labels = F.array(*[F.lit(x) for x in DAY_LABELS])
    windows = F.array(*[F.lit(x) for x in TIME_WINDOWS])
    n_cols = len(DAY_LABELS) * len(TIME_WINDOWS)
    # day labels only above the first column of each day; a time label above every column
    day_heads = F.transform(
        F.sequence(F.lit(0), F.lit(len(DAY_LABELS) - 1)), lambda d: cell(F.lit(3), d * 3 + 1, F.element_at(day_labels, d + 1))
    )
    window_heads = F.transform(
        F.sequence(F.lit(0), F.lit(n_cols - 1)), lambda i: cell(F.lit(4), i + 1, F.element_at(windows, i % 3 + 1))
    )
    header_cells = sheets.select(*keys, F.inline(F.concat(F.array(*fixed), day_heads, window_heads)))

    reason_cells = reasons.select(
        *keys,
        F.inline(
            F.array(
                cell(F.col("ri") + 5, F.lit(0), F.col("reason")),
                cell(F.col("R") + 8 + F.col("ri"), F.lit(0), F.col("reason")),
                cell(F.col("R") * 2 + 11 + F.col("ri"), F.lit(0), F.col("reason")),
            )
        ),
    )
    rk = reasons.select(*keys, "reason", "ri", "R")
    # every count lands in its section's block: s=0 day x window, s=1 borough, s=2 board
    body = counts.join(rk, keys + ["reason"])
    body_cells = body.select(
        *keys,
        F.when(F.col("s") == 0, F.col("ri") + 5)
        .when(F.col("s") == 1, F.col("R") + 8 + F.col("ri"))
        .otherwise(F.col("R") * 2 + 11 + F.col("ri"))
        .alias("row"),
        F.when(F.col("s") == 0, F.col("k1") * 3 + F.col("k2") + 1).otherwise(F.col("k1") + 1).alias("col"),
        F.col("n").cast("string").alias("value"),
    )
    section_heads = (
        body.filter(F.col("s") > 0)
        .select(*keys, "s", "k1", "nm", "R")
        .distinct()
        .select(
            *keys,
            F.when(F.col("s") == 1, F.col("R") + 7).otherwise(F.col("R") * 2 + 10).alias("row"),
            (F.col("k1") + 1).alias("col"),
            F.when(F.col("s") == 1, F.upper("nm"))
            .otherwise(F.concat(F.lit("Board   "), (F.col("k1") + 1).cast("string")))
            .alias("value"),
        )
    )
    decoy = sheets.select("file").distinct().select(
        "file", F.lit("Reject Category Summary").alias("sheet"), F.lit(0).alias("row"), F.lit(0).alias("col"), F.lit(SECTION_DAY).alias("value")
    )
    cols = ["file", "sheet", "row", "col", "value"]
    out = header_cells.select(*cols)
    for part in (reason_cells, body_cells, section_heads, decoy):
        out = out.unionByName(part.select(*[F.col(c).cast("int") if c in ("row", "col") else F.col(c) for c in cols]))
    return out


def report_cell_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report cells landed once per application in the shared folder."""
    return spark.read.parquet(landed(spark, sf_dir, "report-cells", report_cells))


# --- file round trip --------------------------------------------------------------

PARTS_SCHEMA = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz"
PARTS_MAX_MB = 64.0
CAPPED_SCHEMA = "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string"
CAPPED_MB = 0.25


def geojson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S as point features written as line-delimited GeoJSON under the shared
    checkpoint folder and read back (S9, S5)."""
    from citybeat.session import scratch_path
    from citybeat.sources.files import read_geojson_seq_points, to_geojson_features, write_geojson_seq

    geo = supplier_geo(spark, sf_dir).join(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey")
    feats = to_geojson_features(geo, "Point", F.array("lng", "lat"), ["s_suppkey", "s_name"])
    path = scratch_path(spark, "geojson")
    write_geojson_seq(feats, path)
    back = read_geojson_seq_points(spark, path)
    return back.select(
        F.col("properties.s_suppkey").cast("long").alias("s_suppkey"),
        F.col("properties.s_name").alias("s_name"),
        "lng",
        "lat",
    )


def parts_roundtrip(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """L written as year-partitioned CSV parts of at most ~64 MB each under the
    shared checkpoint folder, then read back through the whole-or-parts
    resolution.  Returns (rows read back, manifest)."""
    from citybeat.session import scratch_path
    from citybeat.sources.files import (
        parts_manifest,
        read_csv,
        resolve_whole_or_parts,
        write_csv_parts_by_size,
        write_parts_manifest,
    )

    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate", F.year("l_shipdate").alias("year")
    )
    root = scratch_path(spark, "parts")
    parts_dir = f"{root}/lineitem_parts"
    write_csv_parts_by_size(li, parts_dir, PARTS_MAX_MB, ["year"])
    write_parts_manifest(spark, parts_dir, "lineitem.csv", f"{root}/lineitem.parts.json")
    paths = resolve_whole_or_parts(
        spark, f"{root}/lineitem.csv", [f"{parts_dir}/year=*/part-*.csv"], manifest=f"{root}/lineitem.parts.json", parts_dir=parts_dir
    )
    back = read_csv(spark, paths, PARTS_SCHEMA).withColumn(
        "year", F.regexp_extract(F.col("_metadata.file_path"), r"year=(\d+)", 1).cast("int")
    )
    manifest = parts_manifest(spark, parts_dir, PARTS_SCHEMA, ["year"])
    return back, manifest


def size_capped_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L in ordered CSV parts of at most a quarter megabyte by year: number in its
    year, rows and bytes of every part, as found on storage."""
    from citybeat.session import scratch_path
    from citybeat.sources.files import parts_manifest, write_csv_parts_by_size

    names = [f.split()[0] for f in CAPPED_SCHEMA.split(", ")]
    li = table(spark, sf_dir, "lineitem").select(*names, F.year("l_shipdate").alias("year"))
    path = scratch_path(spark, "capped")
    cap = write_csv_parts_by_size(li, path, CAPPED_MB, ["year"])
    by_name = Window.partitionBy("year").orderBy("file_name")
    return parts_manifest(spark, path, CAPPED_SCHEMA, ["year"]).select(
        "year", F.row_number().over(by_name).alias("part"), "rows", "bytes", (F.col("bytes") <= cap).alias("under_cap")
    )


def feature_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C as one FeatureCollection in parts, read back by splits."""
    from citybeat.session import scratch_path
    from citybeat.sources.files import read_feature_collection, to_geojson_features, write_feature_collection

    places = customer_places(spark, sf_dir).join(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), "c_custkey")
    named = places.select("*", F.lit("Feature").alias("kind"))
    feats = to_geojson_features(
        named, "Point", F.array(F.col("x").cast("double"), F.col("y").cast("double")), ["kind", "c_custkey", "c_mktsegment"], keep=["c_custkey"]
    )
    path = scratch_path(spark, "collection")
    write_feature_collection(feats, path, "c_custkey")
    back = read_feature_collection(spark, path, "struct<kind:string,c_custkey:long,c_mktsegment:string>")
    return back.select("properties.c_custkey", "properties.c_mktsegment", "properties.kind", "lng", "lat")
