"""Exact dedup by content sort, in DataFrame functions only.

Normalised texts are range-partitioned by sampled splitters and sorted inside
each partition, so equal texts lie next to each other; the window operator
reads the sorted run and compares each row's whole text with its neighbour's
to find where a group of equals ends.  The row that stays is the first of its
group in the order (most code points, smallest id).

A text copied into a large part of all rows would make one range partition
hold all its copies.  Such texts are found first by counting 64-bit hashes
(partial aggregation, no text is shuffled); their rows get a salt behind the
text in the sort key, one value per ``run`` rows, so the splitters can cut the
group.  Each salted run elects its head the same way, and the heads - one per
run - are merged in a second, small step.  At most ``MAX_HOT`` texts can reach
the threshold, which bounds the broadcast list.  A hash shared by two texts
only adds a salt: equality is decided on whole texts.

Edge cases: null text is empty; texts of white space only are equal to the
empty text; null ids sort last; of repeated rows exactly one is kept; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citybeat.llm.common import ASCII_SPACE, code_points, numbered

#: Upper bound of the number of texts that are salted, and so of the broadcast list.
MAX_HOT = 1 << 16
#: Copies below this never count as hot.
MIN_RUN = 64
#: Leading characters in the range key: splitters are sampled rows' keys, so the key is bounded;
#: behind the head the text's hash orders, and the whole text decides.
HEAD = 64


def normalised(text: F.Column) -> F.Column:
    """The text without ASCII white space; null counts as empty."""
    return reduce(lambda c, space: F.replace(c, F.lit(space), F.lit("")), ASCII_SPACE, F.coalesce(text, F.lit("")))


def _hot_texts(rows: DataFrame) -> DataFrame:
    """(hot_hash, n_runs) of the texts with more copies than a run holds."""
    run = max(MIN_RUN, -(-rows.count() // MAX_HOT))
    return (
        rows.groupBy(F.col("text_hash").alias("hot_hash"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > run)
        .select("hot_hash", F.ceil(F.col("n") / F.lit(run)).cast("long").alias("n_runs"))
    )


def _sorted_runs(df: DataFrame, key: str, text: str, carry: list[str], only_hot: bool = False) -> DataFrame:
    """Every row (or every row of a salted text) with its place and the head of its sorted run; ``carry`` in ``row``."""
    rows = df.select(
        F.col(key).cast("long").alias("doc_id"),
        normalised(F.col(text)).alias("norm"),
        code_points(F.col(text)).alias("n_points"),
        *([F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []),
    ).withColumn("text_hash", F.xxhash64("norm"))
    hot = F.broadcast(_hot_texts(rows.select("text_hash")))
    salted = rows.join(hot, F.col("text_hash") == F.col("hot_hash"), "left").select(
        "doc_id",
        "norm",
        F.substring("norm", 1, HEAD).alias("head"),
        "text_hash",
        "n_points",
        *(["row"] if carry else []),
        F.coalesce("n_runs", F.lit(1)).alias("n_runs"),
        F.coalesce(F.pmod(F.xxhash64("doc_id"), "n_runs"), F.lit(0)).alias("salt"),
    )
    if only_hot:
        salted = salted.filter("n_runs > 1")
    run = Window.partitionBy("head", "text_hash", "salt", "norm")
    ordered = run.orderBy(F.col("n_points").desc(), F.col("doc_id").asc_nulls_last())
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return (
        salted.repartitionByRange("head", "text_hash", "salt")
        .withColumn("place", F.row_number().over(ordered))
        .withColumn("head_id", F.first("doc_id").over(whole))
        .withColumn("head_points", F.first("n_points").over(whole))
        .withColumn("run_size", F.count(F.lit(1)).over(whole))
        .select(
            "doc_id",
            "n_runs",
            "salt",
            "place",
            "head_id",
            "head_points",
            "run_size",
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            *(["row"] if carry else []),
        )
    )


def exact_groups(df: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    With ``carry`` these columns of the input come along in a struct ``row``.
    """
    runs = _sorted_runs(df, key, text, carry or [])
    # only the salted texts are sorted a second time, for their heads
    heads = _sorted_runs(df, key, text, [], only_hot=True).filter(F.col("place") == 1)
    best = F.min(
        F.struct(
            (-F.col("head_points")).alias("p"),
            F.col("head_id").isNull().alias("z"),
            F.col("head_id").alias("id"),
            F.col("salt").alias("salt"),
        )
    )
    merged = (
        heads.groupBy(F.col("text_sha256").alias("merged_sha"))
        .agg(best.alias("best"), F.sum("run_size").alias("merged_size"))
        .select("merged_sha", F.col("best.id").alias("merged_id"), F.col("best.salt").alias("merged_salt"), "merged_size")
    )
    # at most MAX_HOT rows: one per salted text
    joined = runs.join(F.broadcast(merged), (F.col("n_runs") > 1) & (F.col("text_sha256") == F.col("merged_sha")), "left")
    salted_row = F.col("merged_sha").isNotNull()
    return joined.select(
        "doc_id",
        F.when(salted_row, F.col("merged_id")).otherwise(F.col("head_id")).alias("keep_id"),
        F.when(salted_row, F.col("merged_size")).otherwise(F.col("run_size")).cast("long").alias("group_size"),
        F.when(salted_row, (F.col("salt") == F.col("merged_salt")) & (F.col("place") == 1))
        .otherwise(F.col("place") == 1)
        .alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, with every column of the input."""
    rows, names = numbered(df)
    kept = exact_groups(rows, names[key], names[text], carry=rows.columns).filter("kept").select("row.*")
    return kept.toDF(*df.columns)
