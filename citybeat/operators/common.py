"""Generic DataFrame operators shared by the dataset modules.

Shares (W1, W8), zero-filled category counts (B1/B3 with R3 semantics),
latest-per-group (W2), per-group and global top-k (W3, W4) and the top-k with
fallback (W7).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citybeat.functions.numeric import round_half_even


def _cols(cols: str | Sequence[str]) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def zero_filled_counts(
    df: DataFrame,
    group_cols: str | Sequence[str],
    label: Column,
    labels: Sequence[str],
    label_col: str,
    count_col: str = "trips",
    weight: Column | None = None,
    extra: Sequence[Column] = (),
) -> DataFrame:
    """Count rows per group and label; every label of ``labels`` is emitted
    (zero when absent) for each group that has at least one row in ``df``.

    One aggregation with a conditional counter per label (partial aggregation
    happens map-side), then an ``unpivot``; there is no join with a label grid.
    With ``weight`` the counters sum that column instead of counting rows.
    ``extra`` aggregates are computed in the same pass and repeated on every
    output row of their group.
    """
    groups = _cols(group_cols)
    aggs = []
    for lbl in labels:
        hit = label == F.lit(lbl)
        if weight is None:
            aggs.append(F.count_if(hit).alias(lbl))
        else:
            aggs.append(F.sum(F.when(hit, weight).otherwise(F.lit(0))).cast("long").alias(lbl))
    wide = df.groupBy(*groups).agg(*aggs, *extra)
    ids = [c for c in wide.columns if c not in set(labels)]
    return wide.unpivot(ids, [F.col(f"`{lbl}`") for lbl in labels], label_col, count_col)


def share_within(df: DataFrame, part_cols: str | Sequence[str], value_col: str, share_col: str = "share", digits: int | None = 4) -> DataFrame:
    """``value / sum(value) over (partition by part_cols)``, rounded half-even.

    Meant for aggregated frames (one row per category inside the partition), so
    each window partition is as small as the number of categories.
    """
    total = F.sum(F.col(value_col)).over(Window.partitionBy(*_cols(part_cols)))
    share = F.col(value_col) / total
    return df.withColumn(share_col, round_half_even(share, digits) if digits is not None else share)


def share_of_total(df: DataFrame, value_col: str, share_col: str = "share", digits: int | None = 4, zero_total_as: float | None = None) -> DataFrame:
    """``value / grand total``.

    ``df`` must already be aggregated to one row per category (providers,
    member types, boroughs ...): the total is a window over that small frame,
    so the source is scanned once and only the category rows meet in one task.
    """
    total = F.sum(F.col(value_col)).over(Window.partitionBy())
    share = F.col(value_col) / total
    if zero_total_as is not None:
        share = F.when(total == 0, F.lit(zero_total_as)).otherwise(share)
    share = round_half_even(share, digits) if digits is not None else share
    return df.withColumn(share_col, share)


def latest_per_group(df: DataFrame, part_cols: str | Sequence[str], order_col: str) -> DataFrame:
    """Rows whose ``order_col`` equals the group maximum.

    ``df`` is aggregated already (categories, not fact rows), so the maximum is
    a window over that frame and the source is scanned once.
    """
    latest = F.max(order_col).over(Window.partitionBy(*_cols(part_cols)))
    return df.withColumn("__latest", latest).filter(F.col(order_col) == F.col("__latest")).drop("__latest")


def top_k_per_group(df: DataFrame, part_cols: str | Sequence[str], order: Sequence[Column], k: int, rank_col: str | None = None) -> DataFrame:
    """First ``k`` rows per group in ``order``.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit
    before the shuffle, so at most ``k`` rows per group leave each map task.
    ``order`` must include tie keys for a deterministic answer.
    """
    w = Window.partitionBy(*_cols(part_cols)).orderBy(*order)
    ranked = df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= k)
    if rank_col:
        return ranked.withColumnRenamed("__rn", rank_col)
    return ranked.drop("__rn")


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Global top-k (W4): planned as TakeOrderedAndProject (per-partition top-k, then merge)."""
    return df.orderBy(*order).limit(k)


def top_k_with_fallback(
    items: DataFrame,
    part_col: str,
    year_col: str,
    order: Sequence[Column],
    k: int,
) -> DataFrame:
    """Top-k of the latest year per group, or of all years when the latest
    year has fewer than ``min(k, rows in group)`` rows (W7)."""
    group = Window.partitionBy(part_col)
    stated = items.withColumn("__latest", F.max(year_col).over(group))
    in_latest = F.col(year_col) == F.col("__latest")
    stated = stated.withColumn("__n_all", F.count(F.lit(1)).over(group)).withColumn(
        "__n_latest", F.count_if(in_latest).over(group)
    )
    keep = in_latest | (F.col("__n_latest") < F.least(F.lit(k), F.col("__n_all")))
    chosen = stated.filter(keep).drop("__latest", "__n_all", "__n_latest")
    return top_k_per_group(chosen, part_col, order, k)
