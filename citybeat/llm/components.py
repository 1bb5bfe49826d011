"""Connected components of a link table, by minimum labels with pointer jumping.

Every round each node takes the smallest label among itself and its
neighbours and then its label's label, so long chains shrink in a logarithmic
number of rounds.  The labels are written to the shared folder each round; the
driver only sees whether anything changed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citybeat.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of ``links`` (columns a, b); label is the component's smallest node."""
    both = materialise(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(),
        "links",
    )
    labels = materialise(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("n"))
            .agg(F.min("label").alias("near"))
        )
        seen = labels.join(near, F.col("node") == F.col("n")).select("node", "label", F.least("label", "near").alias("next"))
        jump = labels.select(F.col("node").alias("via"), F.col("label").alias("far"))
        stepped = materialise(
            seen.join(jump, F.col("next") == F.col("via"), "left").select(
                "node", F.col("label").alias("before"), F.least("next", F.coalesce("far", "next")).alias("label")
            ),
            "labels",
        )
        labels = stepped.select("node", "label")
        if stepped.filter("label < before").isEmpty():
            return labels
