"""Query catalog: every registered query and its SQL oracle.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame over the whole driver
tables; ``ORACLES[name]`` is an independent DuckDB statement over the same
tables (views named after the tables).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import Window
from pyspark.sql import functions as F

from citybeat.constants import CANDIDATE_LIMIT, CIRCLE_MODES, MINUTES, NETWORK_MODES, TARGET_ROUTES, TIP_LABELS, TIP_ZERO_LABEL
from citybeat.functions.datetime import compact_digits_to_timestamp, epoch_to_timestamp
from citybeat.operators import bikes, grid, groups, leaf_index, network, outline, polygons, reports, ridership, sampling, spatial, taxi, traffic
from citybeat.operators.common import top_k
from citybeat.plans import bindings as B
from citybeat.plans import oracle_bikes, oracle_geo, oracle_misc, oracle_reports, oracle_taxi, oracle_traffic

Query = Callable[[SparkSession, str], DataFrame]

# W7 size: service R has a hundred zones in its latest year and falls back to all years; the others have more from sf0.01 on.
FALLBACK_K = 150


def _folder_trips(s: SparkSession, d: str) -> DataFrame:
    """Trips, exact minutes and shared rides per month over the discovered year folders."""
    trips = B.folder_trips(s, d)
    return trips.groupBy("service", "year", "month").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.rint("duration_min").cast("long")).alias("minutes"),
        F.count_if(F.col("trip_distance") >= 5.0).alias("long_trips"),
        F.count_if("shared_trip").alias("shared"),
        F.count("shared_trip").alias("shared_known"),
    )


def _taxi_queries() -> dict[str, Query]:
    return {
        "trips_monthly": lambda s, d: taxi.chart_ready(
            taxi.monthly_volume(B.trips(s, d)), ["A", "N", "R"], B.TRIP_YEARS, "trips"
        ),
        "folder_trips": _folder_trips,
        "observed_days": lambda s, d: taxi.observed_days(B.event_trips(s, d)),
        "pickup_counts": lambda s, d: taxi.pickup_counts(B.trips(s, d)),
        "od_counts": lambda s, d: taxi.od_counts(B.trips(s, d)),
        "trips_dow_hour_avg": lambda s, d: taxi.dow_hour_average(B.event_trips(s, d)),
        "distance_bins": lambda s, d: taxi.distance_bins(B.trips(s, d)),
        "duration_bins": lambda s, d: taxi.duration_bins(B.trips(s, d)),
        "tip_bins": lambda s, d: taxi.tip_rate_bins(B.trips(s, d)),
        "fare_components": lambda s, d: taxi.fare_components(B.trips(s, d)),
        "airport_share": lambda s, d: taxi.airport_share(B.trips(s, d)),
        "shared_share": lambda s, d: taxi.shared_share(B.trips(s, d)),
        "provider_share": lambda s, d: taxi.provider_share(B.trips_with_provider(s, d)),
        "zone_borough_share": lambda s, d: taxi.borough_share(B.trips(s, d), B.zones(s, d)),
        "top_zones": lambda s, d: taxi.top_pickup_zones(B.trips(s, d), B.zones(s, d)),
        "top_od": lambda s, d: taxi.top_od_pairs(B.trips(s, d), B.zones(s, d)),
        "top_items_with_fallback": lambda s, d: taxi.top_zones_with_fallback(B.thin_year_trips(s, d), FALLBACK_K),
    }


def _bike_queries() -> dict[str, Query]:
    return {
        "clean_bikes": lambda s, d: B.bike_trips(s, d),
        "top_flows": lambda s, d: bikes.top_flows(B.nation_flow_trips(s, d)),
        "top_stations": lambda s, d: bikes.top_start_stations(B.nation_flow_trips(s, d)),
        "hourly_by_user": lambda s, d: bikes.hourly_by_user(B.bike_trips(s, d)),
        "weekday_by_user": lambda s, d: bikes.weekday_by_user(B.bike_trips(s, d)),
        "type_share": lambda s, d: bikes.rideable_type_share(B.bike_trips(s, d)),
        "member_share": lambda s, d: bikes.member_share(B.bike_trips(s, d)),
        "bike_duration_bins": lambda s, d: bikes.duration_bins(B.bike_trips(s, d)),
        "duration_member_pivot": lambda s, d: bikes.duration_member_pivot(B.bike_trips(s, d)),
    }


def _traffic_queries() -> dict[str, Query]:
    return {
        "clean_traffic": lambda s, d: B.traffic_counts(s, d),
        "hourly_by_borough": lambda s, d: traffic.hourly_by_borough(B.traffic_counts(s, d)),
        "monthly_by_borough": lambda s, d: traffic.monthly_by_borough(B.traffic_counts(s, d)),
        "weekend_by_borough": lambda s, d: traffic.weekend_by_borough(B.traffic_counts(s, d)),
        "weekday_share": lambda s, d: traffic.weekday_share(B.traffic_counts(s, d)),
        "direction_by_borough": lambda s, d: traffic.direction_by_borough(B.traffic_counts(s, d)),
        "day_of_week": lambda s, d: traffic.day_of_week(B.traffic_counts(s, d)),
        "borough_avg": lambda s, d: traffic.borough_average(B.traffic_counts(s, d)),
        "top_corridors": lambda s, d: traffic.top_corridors(B.traffic_counts(s, d)),
        "weekend_pivot": lambda s, d: traffic.weekend_pivot(B.traffic_counts(s, d), B.BOROUGH_ORDER),
    }


def _epoch_units(s: SparkSession, d: str) -> DataFrame:
    rows = B.epoch_rows(s, d)
    return rows.select(
        "event_id",
        "epoch_value",
        epoch_to_timestamp("epoch_value", integral=True).cast("timestamp_ntz").alias("from_epoch"),
        "digits",
        compact_digits_to_timestamp("digits").cast("timestamp_ntz").alias("from_digits"),
    )


def _means(s: SparkSession, d: str) -> DataFrame:
    return ridership.mode_year_means(B.ridership_rows(s, d))


def _misc_queries() -> dict[str, Query]:
    return {
        "epoch_units": _epoch_units,
        "ridership_mean": lambda s, d: _means(s, d).select("mode", "year", "ridership"),
        "mode_totals": lambda s, d: ridership.year_totals(_means(s, d), B.KNOWN_MODES),
        "mode_share": lambda s, d: ridership.mode_share(_means(s, d)),
        "latest_year_share": lambda s, d: ridership.latest_year_share(_means(s, d), B.KNOWN_MODES),
        "featured_years": lambda s, d: ridership.featured_years(_means(s, d)),
        "year_mode_pivot": lambda s, d: ridership.stacked_pivot(_means(s, d), B.KNOWN_MODES),
        "distinct_years": lambda s, d: ridership.distinct_years(B.ridership_rows(s, d)),
        "category_grid": lambda s, d: grid.category_grid(
            taxi.tip_rate_bins(B.trips(s, d)), "service", "tip_bin", "trips", [TIP_ZERO_LABEL] + TIP_LABELS
        ),
        "systematic_sample": lambda s, d: sampling.systematic_sample(
            B.table(s, d, "events").select("event_id", "event_type", F.col("ts"), "value"),
            ["event_type"], ["ts", "event_id"], 500,
        ),
    }


def _rings(s: SparkSession, d: str) -> DataFrame:
    return spatial.ring_points(B.supplier_geo(s, d), CIRCLE_MODES, MINUTES)


def _candidates(s: SparkSession, d: str) -> DataFrame:
    flows = bikes.route_candidates(bikes.top_flows(B.nation_flow_trips(s, d)))
    return top_k(flows, [F.col("trip_count").desc(), F.col("start_station_id"), F.col("end_station_id")], CANDIDATE_LIMIT)


def _reachable_costs(s: SparkSession, d: str) -> DataFrame:
    edges = network.travel_times(B.graph_edges(s, d), {"cycling": NETWORK_MODES["cycling"]})
    return network.bounded_costs(B.graph_sources(s, d), edges, "travel_time", cutoff=600.0)


def _reachable(s: SparkSession, d: str) -> DataFrame:
    return network.reachable_bands(_reachable_costs(s, d), [5, 10])


# The graph's metre plane: x = (lng - LNG0) * 1e5, y = (lat - LAT0) * 1e5.
LNG0, LAT0 = -74.1, 40.5


def _plane(c: str, origin: float) -> F.Column:
    return F.rint((F.col(c) - F.lit(origin)) * 1e5).cast("long")


def _routes(s: SparkSession, d: str) -> DataFrame:
    """Routes for the top station pairs over the part of the supplier road graph that lies in their padded
    bounding box; outlines in degrees."""
    cand = _candidates(s, d).withColumn(
        "cand_idx",
        F.row_number().over(
            Window.orderBy(F.col("trip_count").desc(), F.col("start_station_id"), F.col("end_station_id"))
        ) - 1,
    ).checkpoint()  # read for the box and for the routes
    box = spatial.padded_bbox(cand).select(
        _plane("west", LNG0).alias("x0"), _plane("east", LNG0).alias("x1"), _plane("south", LAT0).alias("y0"), _plane("north", LAT0).alias("y1")
    ).first()
    nodes = B.graph_nodes(s, d)
    if box["x0"] is not None:
        nodes = nodes.filter(F.col("x").between(box["x0"], box["x1"]) & F.col("y").between(box["y0"], box["y1"]))
    edges = network.induced_subgraph(B.graph_edges(s, d), nodes)
    cand = cand.withColumns(
        {f"{end}_{to}": _plane(f"{end}_{of}", origin) for end in ("start", "end") for to, of, origin in (("x", "lng", LNG0), ("y", "lat", LAT0))}
    )
    lines = network.route_lines(cand, nodes, edges, TARGET_ROUTES)
    lng, lat = lambda p: F.lit(LNG0) + p["x"] / 1e5, lambda p: F.lit(LAT0) + p["y"] / 1e5
    coords = F.transform("points", lambda p: F.format_string("[%.6f, %.6f]", lng(p), lat(p)))
    return lines.select(
        "route_id", "start_station_id", "start_station_name", "end_station_id", "end_station_name", "trip_count", "distance_m",
        F.concat(F.lit("["), F.array_join(coords, ", "), F.lit("]")).alias("coords"),
    )


# Transit binding: metres around a stop and around the centre in which a mode's nodes lie.
TRANSIT = {"bus": (400, 2000), "subway": (600, 3000)}
TRANSIT_CENTER = (10000, 10000)


def _transit_bands(s: SparkSession, d: str) -> DataFrame:
    """The transit isochrone chain: per mode the nodes near its stops, the subgraph they induce, the centre
    snapped to its nearest node, bounded costs on that subgraph, bands."""
    nodes, stops = B.graph_nodes(s, d), B.customer_stops_m(s, d)
    center = s.range(1).select(F.lit(0).alias("pt"), *[F.lit(v).cast("long").alias(c) for c, v in zip("xy", TRANSIT_CENTER)])
    edges, sources = None, None
    for mode, (stop_radius, start_radius) in TRANSIT.items():
        allowed = network.allowed_nodes(nodes, stops, stop_radius, TRANSIT_CENTER, start_radius)
        part = network.travel_times(network.induced_subgraph(B.graph_edges(s, d), allowed), {mode: NETWORK_MODES[mode]})
        start = leaf_index.nearest(center, allowed, "pt", "node_id").select(F.lit(mode).alias("mode"), F.col("node_id").alias("source"))
        edges = part if edges is None else edges.unionByName(part)
        sources = start if sources is None else sources.unionByName(start)
    costs = network.bounded_costs(sources, edges, "travel_time", cutoff=600.0, keys=["mode"])
    return network.reachable_bands(costs, [5, 10])


def _isochrone_outlines(s: SparkSession, d: str) -> DataFrame:
    """The rings around the cells of every transit band."""
    cells = network.covered_cells(_transit_bands(s, d), B.graph_nodes(s, d), 100, 200, ["mode"])
    return outline.outlines(cells, ["mode", "source", "minutes"], 100)


# Metres that the fastest mode covers within ten minutes.
MODE_REACH_M = max(NETWORK_MODES.values()) * 1000.0 / 3600.0 * 600.0


def _lengths(s: SparkSession, d: str) -> DataFrame:
    return network.bounded_costs(B.graph_sources(s, d), B.graph_edges(s, d), "length", cutoff=MODE_REACH_M)


def _reachable_by_mode(s: SparkSession, d: str) -> DataFrame:
    """All travel modes at once: one search on length, cut at each mode's limits."""
    return network.mode_bands(_lengths(s, d), NETWORK_MODES, [5, 10])


def _points_in_polygons(s: SparkSession, d: str) -> DataFrame:
    """Customers in any supplier's zone; cells of about half a zone."""
    size = B.zone_size(s, d)
    return polygons.points_in_polygons(B.customer_places(s, d), B.zone_polygons(s, d, size), cell=max(1, size // 2))


def _geo_queries() -> dict[str, Query]:
    return {
        "points_in_polygons": _points_in_polygons,
        "near_stops": lambda s, d: leaf_index.within_distance(
            B.customer_places(s, d), B.supplier_places(s, d), B.zone_size(s, d) // 2, center=(500000, 500000), center_radius=80000
        ),
        "nearest_stop": lambda s, d: leaf_index.nearest(
            B.customer_places(s, d), B.supplier_places(s, d), "c_custkey", "s_suppkey"
        ),
        "route_overlap": lambda s, d: spatial.route_overlap(B.order_routes(s, d)),
        "route_groups": lambda s, d: groups.route_groups(B.order_routes(s, d)),
        "shared_segments": lambda s, d: groups.shared_segments(B.order_routes(s, d)),
        "endpoint_roles": lambda s, d: spatial.endpoint_roles(B.order_routes(s, d)),
        "station_rings": _rings,
        "latest_isochrones": lambda s, d: network.latest_isochrones(_rings(s, d), "cycling"),
        "candidates_bbox": lambda s, d: spatial.padded_bbox(_candidates(s, d)),
        "edge_travel_time": lambda s, d: network.travel_times(B.graph_edges(s, d), NETWORK_MODES),
        "induced_subgraph": lambda s, d: network.induced_subgraph(
            B.graph_edges(s, d),
            network.allowed_nodes(B.graph_nodes(s, d), B.customer_stops_m(s, d), 400, (10000, 10000), 2000),
        ),
        "reachable": _reachable,
        "transit_bands": _transit_bands,
        "isochrone_outlines": _isochrone_outlines,
        "reachable_by_mode": _reachable_by_mode,
        "coverage_by_mode": lambda s, d: network.coverage(_lengths(s, d), B.graph_nodes(s, d), 100, 200, [5, 10], NETWORK_MODES),
        "coverage_cells": lambda s, d: network.coverage(_reachable_costs(s, d), B.graph_nodes(s, d), 100, 200, [5, 10]),
        "routes": _routes,
    }


def _report_queries() -> dict[str, Query]:
    return {
        "report_unpivot_day": lambda s, d: reports.tidy_reports(B.report_cell_table(s, d), ("day_of_week",)),
        "report_unpivot_borough": lambda s, d: reports.tidy_reports(B.report_cell_table(s, d), ("borough",)),
        "report_unpivot_board": lambda s, d: reports.tidy_reports(B.report_cell_table(s, d), ("community_board",)),
    }


def _source_queries() -> dict[str, Query]:
    return {
        "parts_roundtrip": lambda s, d: B.parts_roundtrip(s, d)[0],
        "geojson_roundtrip": B.geojson_roundtrip,
        "feature_collection": B.feature_collection,
        "size_capped_parts": B.size_capped_parts,
        "parts_manifest": lambda s, d: B.parts_roundtrip(s, d)[1].groupBy("year").agg(F.sum("rows").alias("rows")),
    }


def _in_utc(fn: Query) -> Query:
    """Calendar parts and timestamp text are defined in UTC: pin the session zone."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return fn(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    out.update(_taxi_queries())
    out.update(_bike_queries())
    out.update(_traffic_queries())
    out.update(_misc_queries())
    out.update(_geo_queries())
    out.update(_report_queries())
    out.update(_source_queries())
    return {name: _in_utc(fn) for name, fn in out.items()}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    out.update(oracle_taxi.oracles())
    out.update(oracle_bikes.oracles())
    out.update(oracle_traffic.oracles())
    out.update(oracle_misc.oracles())
    out.update(oracle_geo.oracles())
    out.update(oracle_reports.oracles())
    out["parts_roundtrip"] = (
        "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice, l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS year "
        "FROM lineitem"
    )
    out["geojson_roundtrip"] = (
        "SELECT s_suppkey, s_name, CAST(-74.05 AS DOUBLE) + (s_suppkey * 53 % 1000) / 10000.0 AS lng, "
        "CAST(40.6 AS DOUBLE) + (s_suppkey * 29 % 1000) / 10000.0 AS lat FROM supplier"
    )
    out["feature_collection"] = oracle_geo.FEATURE_COLLECTION
    out["size_capped_parts"] = oracle_misc.SIZE_CAPPED_PARTS
    out["parts_manifest"] = "SELECT CAST(year(l_shipdate) AS INTEGER) AS year, count(*) AS rows FROM lineitem GROUP BY 1"
    return out
