"""Mixing sources to target weights: weighted sampling without replacement, in DataFrame functions only.

The sources share a budget by weight.  A source's target stops at ``most``
times its size and the excess is shared again by weight, until none is above.
A target is met by whole epochs first: every document of the source is taken
``floor(target / size)`` times.  The fraction left is drawn after
Efraimidis and Spirakis: a document's key is ``-ln(u) / weight`` with u uniform
from a hash of the document and weight its quality weight, and documents are
taken in key order until the prefix sum of their sizes reaches the budget; the
document on the line is taken in part.

A source may hold a third of all rows, so no source is sorted whole.  Its keys
are dealt into buckets by ``1 - exp(-key)``, as many as the square root of its
rows (weights are clipped to [1 / MAX_WEIGHT, MAX_WEIGHT], which bounds a
bucket's share); sums per bucket, aggregated before the shuffle, show the one
bucket that the budget ends in, and only that bucket's rows are sorted and
summed.  The selection is that of a sort of the whole source.

Edge cases: null text has size 0, sources of size 0 have target 0; null is a
source of its own, last; null ids are hashed as nulls; repeated rows have equal
keys and are told apart only by their place in the order, so the result is the
same on every run; missing, null and not positive weights count as 1 and
1 / MAX_WEIGHT; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citybeat.llm.common import materialise

#: Quality weights are clipped to [1 / MAX_WEIGHT, MAX_WEIGHT].
MAX_WEIGHT = 16.0

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: F.Column) -> F.Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_weights(rows: DataFrame, pattern: Sequence[float]) -> DataFrame:
    """(source, source_size, n_rows, weight): weights by the source's place in code-point order, null last.

    Places are counted in range-partitioned slices with offsets per slice, so
    the list of sources may be long.
    """
    totals = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    sliced = materialise(
        totals.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("slice", F.spark_partition_id()), "mix-sources"
    )
    before = F.coalesce(F.sum("n").over(Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # one row a slice
    offsets = sliced.groupBy("slice").agg(F.count(F.lit(1)).alias("n")).select("slice", before.alias("before"))
    place = F.row_number().over(Window.partitionBy("slice").orderBy(F.col("source").asc_nulls_last())) - 1 + F.col("before")
    weights = F.array(*[F.lit(float(w)) for w in pattern])
    return sliced.join(offsets, "slice").select(
        "source", "source_size", "n_rows", F.get(weights, (place % len(pattern)).cast("int")).alias("weight")
    )


def targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """``sources`` with ``target``: ``share`` of all sizes by weight, none above ``most`` times its source's size.

    Each round shares what the capped sources leave among the others and caps
    those that come out above; the driver sees three sums a round.
    """
    cap = F.lit(float(most)) * F.col("source_size")
    level, capped = F.lit(None).cast("double"), F.lit(False)
    total, n_capped = None, 0
    while True:
        got = sources.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"),
            F.coalesce(F.sum(F.when(capped, cap)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(capped).alias("n"),
        ).first()
        if total is not None and got["n"] == n_capped or not got["weight"]:
            break
        total, n_capped = got["size"], got["n"]
        level = F.lit((share * total - got["full"]) / got["weight"])
        capped = cap < level * F.col("weight")
    target = F.when(level.isNull() | capped, cap).otherwise(level * F.col("weight"))
    return sources.withColumn("target", target)


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    pattern: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 17,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, epochs, taken (words, repeats counted).

    ``quality``: optional (doc_id, weight), one row a document at most.
    ``pattern``: the sources' weights in order, repeating.
    """
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        F.xxhash64(F.lit(seed), F.col(key), F.col(text)).alias("hash"),
    )
    weight = F.lit(1.0)
    if quality is not None:
        rows = rows.join(quality.select(F.col("doc_id").alias("q_id"), F.col("weight").alias("w")), F.col("doc_id") == F.col("q_id"), "left")
        # a comparison with NaN is true from above only: such a weight is clipped
        weight = F.greatest(F.least(F.coalesce("w", F.lit(1.0)), F.lit(MAX_WEIGHT)), F.lit(1 / MAX_WEIGHT))
    # 53 bits of the hash, never 0
    u = (F.shiftrightunsigned("hash", 11).cast("double") + 0.5) / float(1 << 53)
    rows = materialise(rows.select("doc_id", "source", "size", "hash", (-F.log(u) / weight).alias("key")), "mix-rows")

    plan = targets(source_weights(rows, pattern), share, most)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    goal = F.rint("target").cast("long")
    plan = materialise(
        plan.withColumn("epochs", epochs).select(
            F.col("source").alias("s"),
            "source_size",
            "target",
            "epochs",
            F.greatest(goal - F.col("epochs") * F.col("source_size"), F.lit(0)).alias("rest"),
            F.ceil(F.sqrt("n_rows")).cast("long").alias("n_buckets"),
        ),
        "mix-plan",
    )
    bucket = F.least(F.floor((1 - F.exp(-F.col("key"))) * F.col("n_buckets")).cast("long"), F.col("n_buckets") - 1)
    dealt = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("bucket", bucket)

    # the bucket of each source that its budget ends in
    sums = dealt.groupBy("s", "bucket", "rest").agg(F.sum("size").alias("bucket_size"))
    until = F.sum("bucket_size").over(Window.partitionBy("s").orderBy("bucket"))
    cuts = sums.withColumn("until", until).filter((F.col("until") > F.col("rest")) & (F.col("until") - F.col("bucket_size") <= F.col("rest")))
    cuts = cuts.select(F.col("s").alias("c"), F.col("bucket").alias("cut"), (F.col("until") - F.col("bucket_size")).alias("cut_before"))
    plan = materialise(plan.join(cuts, F.col("s").eqNullSafe(F.col("c")), "left").drop("c"), "mix-cuts")

    placed = rows.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("bucket", bucket)
    on_line = F.col("bucket").eqNullSafe(F.col("cut"))
    order = Window.partitionBy("s").orderBy("key", "doc_id", "hash", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("cut_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    # a source without a cut has no more words than its rest
    fraction = F.when(F.col("cut").isNull() | (F.col("bucket") < F.col("cut")), F.col("size")).otherwise(0)
    parts = placed.filter(~on_line).withColumn("fraction", fraction).unionByName(
        placed.filter(on_line).withColumn("fraction", F.greatest(F.least(F.col("rest") - before, F.col("size")), F.lit(0)))
    )
    return parts.select(
        "doc_id", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size") + F.col("fraction")).alias("taken")
    )


def label_weights(labels: DataFrame, good: float = 2.0, bad: float = 0.5) -> DataFrame:
    """(doc_id, weight) from quality labels: ``good`` for 1, ``bad`` for 0; of several labels of a document the best."""
    best = labels.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return best.select("doc_id", F.when(F.col("quality") > 0, F.lit(good)).otherwise(F.lit(bad)).alias("weight"))
