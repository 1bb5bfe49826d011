"""Systematic sampling per group (W10) without a global window.

Keep every ``step``-th row of each group in (order) order, step =
ceil(n / target).  A row's position in its group is found without sorting a
whole group in one task: rows are range-partitioned on (group, order), the
per-partition group counts give each slice its starting offset, and the
position is offset + row number inside the slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citybeat.session import ensure_checkpoint_dir


def systematic_sample(
    df: DataFrame,
    group_cols: Sequence[str],
    order_cols: Sequence[str],
    target: int,
    num_slices: int | None = None,
) -> DataFrame:
    """Rows whose 0-based position within their group is a multiple of
    ceil(n_group / target); groups with n <= target are kept whole.

    ``order_cols`` must make the order total (end with a unique key).  Slice
    ids come from one range shuffle whose output is checkpointed, so the
    per-slice counts and the indexing see the same slices, also after an
    executor is lost.
    """
    groups, order = list(group_cols), list(order_cols)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_slices = num_slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    parted = (
        df.repartitionByRange(n_slices, *groups, *order)
        .withColumn("__slice", F.spark_partition_id())
        .checkpoint()
    )

    per_slice = parted.groupBy(*groups, "__slice").agg(F.count(F.lit(1)).alias("__cnt"))
    before = Window.partitionBy(*groups).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(
        *groups,
        "__slice",
        F.coalesce(F.sum("__cnt").over(before), F.lit(0)).alias("__offset"),
        F.sum("__cnt").over(Window.partitionBy(*groups)).alias("__n"),
    )
    local = Window.partitionBy(*groups, "__slice").orderBy(*order)
    indexed = parted.join(offsets, on=[*groups, "__slice"]).withColumn(
        "__pos", F.col("__offset") + F.row_number().over(local) - 1
    )
    step = F.greatest(F.lit(1), F.ceil(F.col("__n") / F.lit(float(target))))
    return indexed.filter((F.col("__n") <= target) | (F.col("__pos") % step == 0)).drop(
        "__slice", "__offset", "__n", "__pos"
    )
