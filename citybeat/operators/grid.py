"""Zero-filled category x series grid."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def category_grid(df: DataFrame, series_col: str, category_col: str, value_col: str, categories: Sequence[str]) -> DataFrame:
    """Every category of ``categories`` for every series present in ``df``;
    missing (series, category) values are 0 and unknown categories dropped.

    Values are first summed per (series, category), so each series folds
    into a map of at most ``len(categories)`` entries; the grid is produced
    by exploding the fixed category list, not by joining two dimensions.
    """
    known = (
        df.filter(F.col(category_col).isin(list(categories)))
        .groupBy(series_col, category_col)
        .agg(F.sum(value_col).alias(value_col))
    )
    per_series = known.groupBy(series_col).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(category_col), F.col(value_col)))).alias("__m")
    )
    cats = F.array(*[F.lit(c) for c in categories])
    exploded = per_series.select(series_col, "__m", F.explode(cats).alias(category_col))
    return exploded.select(
        series_col,
        category_col,
        F.coalesce(F.col("__m")[F.col(category_col)], F.lit(0).cast("long")).alias(value_col),
    )
