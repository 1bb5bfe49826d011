"""Ridership by mode and year.

A mean is its exact sum (integer cents) divided once by its count.  Totals,
shares and stacked offsets add means in integer units of 1e-8, so that they
do not depend on partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Units of a mean in sums.
UNITS = 1e8


def mode_year_means(rows: DataFrame) -> DataFrame:
    """mode, year -> mean ridership of the rows for that key.

    ``rows`` has columns mode, year, ridership.  ``ridership`` is the
    unrounded mean, ``ridership_units`` the same in units of ``1 / UNITS``.
    """
    cents = F.rint(F.col("ridership") * 100.0).cast("long")
    agg = rows.filter(F.col("year").isNotNull()).groupBy("mode", "year").agg(
        F.sum(cents).alias("__c"), F.count(F.lit(1)).alias("__n")
    )
    mean = F.col("__c") / F.col("__n")
    return agg.select("mode", "year", F.rint(mean * (UNITS / 100.0)).cast("long").alias("ridership_units"), (mean / 100.0).alias("ridership"))


def year_totals(means: DataFrame, modes: Sequence[str] | None = None) -> DataFrame:
    """year -> total of the mode means (A28); ``modes`` restricts to known modes."""
    m = means.filter(F.col("mode").isin(list(modes))) if modes else means
    return m.groupBy("year").agg((F.sum("ridership_units") / UNITS).alias("total"))


def full_grid(means: DataFrame) -> DataFrame:
    """Every observed year x every observed mode, 0 where the pair is missing.

    The list of modes is a scalar aggregate of the same plan, so nothing runs
    while the query is planned; the grid is not a join of two dimensions.
    """
    mode = F.coalesce("mode", F.lit("null"))
    modes = means.agg(F.array_sort(F.collect_set(mode))).scalar()
    wide = means.groupBy("year").agg(F.map_from_entries(F.collect_list(F.struct(mode, "ridership_units"))).alias("units"))
    long = wide.select("year", "units", F.explode(modes).alias("mode"))
    units = F.coalesce(F.col("units")[F.col("mode")], F.lit(0).cast("long"))
    return long.select("year", "mode", units.alias("ridership_units"))


def mode_share(means: DataFrame) -> DataFrame:
    """year, mode -> value and share of the year's total over all modes,
    0 when the total is 0; the year x mode grid is zero filled (W5)."""
    grid = full_grid(means)
    total = F.sum("ridership_units").over(Window.partitionBy("year"))
    return grid.select(
        "year",
        "mode",
        (F.col("ridership_units") / UNITS).alias("ridership"),
        (total / UNITS).alias("total"),
        F.when(total == 0, F.lit(0.0)).otherwise(F.col("ridership_units") / total).alias("share"),
    )


def latest_year_share(means: DataFrame, modes: Sequence[str]) -> DataFrame:
    """Share of each known mode in the latest year (W6); missing modes are 0
    and a zero total counts as 1."""
    latest = means.withColumn("__ly", F.max("year").over(Window.partitionBy()))
    latest = latest.filter(F.col("year") == F.col("__ly")).drop("__ly")
    wide = latest.groupBy("year").pivot("mode", list(modes)).agg(F.first("ridership_units"))
    long = wide.unpivot(["year"], [F.col(f"`{m}`") for m in modes], "mode", "ridership_units")
    long = long.withColumn("ridership_units", F.coalesce(F.col("ridership_units"), F.lit(0).cast("long")))
    total = F.sum("ridership_units").over(Window.partitionBy("year"))
    denom = F.when(total == 0, F.lit(1)).otherwise(total)
    return long.select(
        "year",
        "mode",
        (F.col("ridership_units") / UNITS).alias("ridership"),
        (F.col("ridership_units") / denom).alias("share"),
    )


def featured_years(means: DataFrame) -> DataFrame:
    """Per mode: its years at positions 0, n/3, 2n/3 and n-1 (all when n <= 4),
    with the year's total over all modes and the mode's share of it (W9)."""
    w = Window.partitionBy("mode").orderBy("year")
    idx = F.row_number().over(w) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy("mode"))
    ranked = means.select("mode", "year", "ridership_units", idx.alias("__i"), n.alias("__n"))
    picks = F.array(F.lit(0), F.floor(F.col("__n") / 3), F.floor(2 * F.col("__n") / 3), F.col("__n") - 1)
    keep = (F.col("__n") <= 4) | F.array_contains(picks.cast("array<long>"), F.col("__i").cast("long"))
    totals = means.groupBy("year").agg(F.sum("ridership_units").alias("__t"))
    return ranked.filter(keep).join(totals, "year").select(
        "mode",
        "year",
        (F.col("ridership_units") / UNITS).alias("ridership"),
        (F.col("__t") / UNITS).alias("total"),
        F.when(F.col("__t") == 0, F.lit(0.0)).otherwise(F.col("ridership_units") / F.col("__t")).alias("share"),
    )


def stacked_pivot(means: DataFrame, modes: Sequence[str]) -> DataFrame:
    """year x known modes, zero filled, with stack offsets y0/y1 in mode order."""
    wide = means.groupBy("year").pivot("mode", list(modes)).agg(F.first("ridership_units"))
    long = wide.unpivot(["year"], [F.col(f"`{m}`") for m in modes], "mode", "ridership_units")
    order = F.array_position(F.array(*[F.lit(m) for m in modes]), F.col("mode"))
    long = long.withColumn("ridership_units", F.coalesce(F.col("ridership_units"), F.lit(0).cast("long")))
    w = Window.partitionBy("year").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    y1 = F.sum("ridership_units").over(w)
    return long.select(
        "year",
        "mode",
        (F.col("ridership_units") / UNITS).alias("ridership"),
        ((y1 - F.col("ridership_units")) / UNITS).alias("y0"),
        (y1 / UNITS).alias("y1"),
    )


def distinct_years(rows: DataFrame) -> DataFrame:
    """Distinct years present."""
    return rows.select("year").where(F.col("year").isNotNull()).distinct()


__all__ = [
    "mode_year_means", "year_totals", "full_grid", "mode_share", "latest_year_share", "featured_years",
    "stacked_pivot", "distinct_years",
]
