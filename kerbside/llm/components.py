"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import stored


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node in `links(a, b)`: root is the least node it is linked with.

    Each round takes the least label among a node and its neighbours, then that label's own
    label, so that a chain of n links needs about log n rounds. Every round is a written table.
    No links give no rows.
    """
    links = links.select("a", "b").where("a <> b")
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                  .distinct(), "links")
    labels = stored(
        both.groupBy("a").agg(F.min("b").alias("b"))
        .select(F.col("a").alias("node"), F.least("a", "b").alias("root")), "labels-0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels.select(F.col("node").alias("b"), "root"), "b")
            .groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        )
        nearer = labels.join(near, "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("via"))
        jump = labels.select(F.col("node").alias("via"), F.col("root").alias("far"))
        after = stored(
            nearer.join(jump, "via")
            .select("node", F.least("via", "far").alias("root"),
                    (F.least("via", "far") != F.col("old")).alias("changed")),
            f"labels-{step}",
        )
        if after.where("changed").isEmpty():
            return after.select("node", "root")
        labels = after.select("node", "root")
