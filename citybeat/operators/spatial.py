"""Route geometry and rings (J7, J8, G1, A29); J4 is in ``polygons``, J5 and J6 are in ``leaf_index``.

Coordinates for the planar joins are integers (e.g. tenths of a unit or
metres) so that distance and orientation tests are exact.  Every join is an
equi-join on grid-cell keys followed by an exact predicate; no operator
compares every point with every other point.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citybeat.constants import EARTH_RADIUS_KM, PAD_DEGREES, POINTS_PER_RING


# --- J7 / J8: route geometry ----------------------------------------------------------


def point_key(lng: Column, lat: Column, digits: int) -> Column:
    """'lng,lat' with both rounded to ``digits`` decimals (as integers of 10^-digits)."""
    scale = float(10 ** digits)
    return F.concat_ws(
        ",",
        F.rint(lng * scale).cast("long").cast("string"),
        F.rint(lat * scale).cast("long").cast("string"),
    )


def route_segments(route_points: DataFrame) -> DataFrame:
    """(route_id, seq, lng, lat) -> (route_id, seg) undirected 5-decimal segment keys."""
    w = Window.partitionBy("route_id").orderBy("seq")
    k = point_key(F.col("lng"), F.col("lat"), 5)
    pts = route_points.withColumn("__k", k).withColumn("__next", F.lead("__k").over(w))
    segs = pts.filter(F.col("__next").isNotNull())
    seg = F.when(F.col("__k") < F.col("__next"), F.concat_ws("|", "__k", "__next")).otherwise(
        F.concat_ws("|", "__next", "__k")
    )
    return segs.select("route_id", seg.alias("seg"))


def route_overlap(route_points: DataFrame) -> DataFrame:
    """Per route: segments, segments shared with another route, overlap flag.

    A segment is shared when the smallest and largest route id using it
    differ: a min/max aggregate, so no route pairs are formed.
    """
    segs = route_segments(route_points)
    per_seg = segs.groupBy("seg").agg((F.min("route_id") != F.max("route_id")).alias("__shared"))
    tagged = segs.join(per_seg, "seg")
    return tagged.groupBy("route_id").agg(
        F.count(F.lit(1)).alias("n_segments"),
        F.count_if("__shared").alias("shared_segments"),
    ).withColumn("has_overlap", F.col("shared_segments") > 0)


def endpoint_roles(route_points: DataFrame) -> DataFrame:
    """Route end points keyed at 6 decimals, with has_start / has_end."""
    ends = route_points.groupBy("route_id").agg(
        F.min_by(F.struct("lng", "lat"), "seq").alias("s"), F.max_by(F.struct("lng", "lat"), "seq").alias("e")
    )
    rows = ends.select(
        F.inline(
            F.array(
                F.struct(F.col("s.lng").alias("lng"), F.col("s.lat").alias("lat"), F.lit(True).alias("is_start")),
                F.struct(F.col("e.lng").alias("lng"), F.col("e.lat").alias("lat"), F.lit(False).alias("is_start")),
            )
        )
    )
    keyed = rows.withColumn("key", point_key(F.col("lng"), F.col("lat"), 6))
    return keyed.groupBy("key").agg(
        F.min("lng").alias("lng"),
        F.min("lat").alias("lat"),
        F.bool_or("is_start").alias("has_start"),
        F.bool_or(~F.col("is_start")).alias("has_end"),
    )


# --- G1: geodesic rings ---------------------------------------------------------------


def ring_points(
    centres: DataFrame,
    modes: dict[str, float],
    minutes: Sequence[int],
    lat: str = "lat",
    lng: str = "lng",
    points: int = POINTS_PER_RING,
    digits: int = 6,
) -> DataFrame:
    """Circle of radius speed x minutes around every centre, ``points + 1``
    vertices on the bearing formula (G1).  Modes, minutes and vertex indices
    are generated with ``explode`` (no join)."""
    mode_arr = F.array(*[F.struct(F.lit(m).alias("mode"), F.lit(float(s)).alias("speed_kmh")) for m, s in modes.items()])
    out = centres.withColumn("__m", F.explode(mode_arr)).withColumn("minutes", F.explode(F.array(*[F.lit(m) for m in minutes])))
    out = out.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(points))))
    dist_km = F.col("__m.speed_kmh") * (F.col("minutes") / 60.0)
    ang = dist_km / EARTH_RADIUS_KM
    lat1, lng1 = F.radians(F.col(lat)), F.radians(F.col(lng))
    bearing = F.lit(2 * math.pi) * (F.col("i") / float(points))
    lat2 = F.asin(F.sin(lat1) * F.cos(ang) + F.cos(lat1) * F.sin(ang) * F.cos(bearing))
    lng2 = lng1 + F.atan2(F.sin(bearing) * F.sin(ang) * F.cos(lat1), F.cos(ang) - F.sin(lat1) * F.sin(lat2))
    scale = float(10 ** digits)
    return out.select(
        *[c for c in centres.columns],
        F.col("__m.mode").alias("mode"),
        "minutes",
        (F.rint(dist_km * 100.0) / 100.0).alias("distance_km"),
        "i",
        (F.rint(F.degrees(lng2) * scale) / scale).alias("ring_lng"),
        (F.rint(F.degrees(lat2) * scale) / scale).alias("ring_lat"),
    )


# --- A29: bounding box ------------------------------------------------------------------


def padded_bbox(candidates: DataFrame, pad: float = PAD_DEGREES) -> DataFrame:
    """west/south/east/north of all candidate end points plus ``pad``."""
    return candidates.agg(
        (F.min(F.least("start_lng", "end_lng")) - pad).alias("west"),
        (F.min(F.least("start_lat", "end_lat")) - pad).alias("south"),
        (F.max(F.greatest("start_lng", "end_lng")) + pad).alias("east"),
        (F.max(F.greatest("start_lat", "end_lat")) + pad).alias("north"),
    )
