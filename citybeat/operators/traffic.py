"""Automated traffic-count cleaning and volume profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.constants import TOP_CORRIDORS
from citybeat.functions.datetime import valid_calendar_date
from citybeat.functions.text import corridor_label, normalize_borough, normalize_direction
from citybeat.operators.common import share_of_total, top_k

REQUIRED = ["Boro", "Yr", "M", "D", "HH", "Vol"]


def clean_counts(raw: DataFrame, parity: bool = False) -> DataFrame:
    """Drop incomplete rows and negative volumes, normalise borough and
    direction, drop impossible dates, add weekday / is_weekend and the
    corridor label (P1, P10-P15)."""
    kept = raw.dropna(subset=REQUIRED).filter(F.col("Vol") >= 0)
    kept = kept.withColumns({"Boro": normalize_borough("Boro"), "Direction": normalize_direction("Direction", parity)})
    date = valid_calendar_date("Yr", "M", "D")
    kept = kept.withColumn("__date", date).filter(F.col("__date").isNotNull())
    return kept.withColumns(
        {
            "weekday": F.weekday("__date"),
            "is_weekend": F.weekday("__date") >= 5,
            "corridor": corridor_label(["street", "fromSt", "toSt", "Direction"]),
        }
    ).drop("__date")


def _avg_by(counts: DataFrame, *keys) -> DataFrame:
    """mean volume per key: exact integer sum / count (one division)."""
    agg = counts.groupBy(*keys).agg(F.sum("Vol").alias("__s"), F.count("Vol").alias("__n"))
    return agg.withColumn("avg_volume", F.col("__s") / F.col("__n")).drop("__s", "__n")


def hourly_by_borough(counts: DataFrame) -> DataFrame:
    """Boro, hour -> avg_volume."""
    return _avg_by(counts, "Boro", F.col("HH").alias("hour"))


def monthly_by_borough(counts: DataFrame) -> DataFrame:
    """Boro, month -> avg_volume."""
    return _avg_by(counts, "Boro", F.col("M").alias("month"))


def weekend_by_borough(counts: DataFrame) -> DataFrame:
    """Boro, is_weekend -> avg_volume."""
    return _avg_by(counts, "Boro", "is_weekend")


def weekday_share(counts: DataFrame) -> DataFrame:
    """is_weekend -> avg_volume over all boroughs (A22, overall)."""
    return _avg_by(counts, "is_weekend")


def direction_by_borough(counts: DataFrame) -> DataFrame:
    """Boro, Direction -> avg_volume."""
    return _avg_by(counts, "Boro", "Direction")


def day_of_week(counts: DataFrame) -> DataFrame:
    """weekday_index (Mon=0) -> avg_volume."""
    return _avg_by(counts, F.col("weekday").alias("weekday_index"))


def borough_average(counts: DataFrame) -> DataFrame:
    """Boro -> avg_volume and its share of the sum of borough averages."""
    avg = _avg_by(counts, "Boro")
    return share_of_total(avg, "avg_volume", zero_total_as=0.0)


def top_corridors(counts: DataFrame, k: int = TOP_CORRIDORS) -> DataFrame:
    """corridor -> total_volume, the k largest."""
    totals = counts.groupBy("corridor").agg(F.sum("Vol").alias("total_volume"))
    return top_k(totals, [F.col("total_volume").desc(), F.col("corridor")], k)


def weekend_pivot(counts: DataFrame, boroughs: Sequence[str] | None = None) -> DataFrame:
    """Boro rows with weekday and weekend average volume columns, 0 when
    missing (R2).  With ``boroughs`` the rows are exactly that fixed list
    (boroughs without counts get zeros, others are left out)."""
    long = weekend_by_borough(counts)
    wide = long.groupBy("Boro").pivot("is_weekend", [False, True]).agg(F.first("avg_volume"))
    if boroughs is not None:
        spark = counts.sparkSession
        order = spark.createDataFrame([(b,) for b in boroughs], "Boro string")
        wide = order.join(wide, "Boro", "left")
    return wide.select(
        "Boro",
        F.coalesce(F.col("false"), F.lit(0.0)).alias("weekday"),
        F.coalesce(F.col("true"), F.lit(0.0)).alias("weekend"),
    )


__all__ = [
    "clean_counts", "hourly_by_borough", "monthly_by_borough", "weekend_by_borough", "weekday_share",
    "direction_by_borough", "day_of_week", "borough_average", "top_corridors", "weekend_pivot",
]
