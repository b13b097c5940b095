"""Connected components of a link table, by smallest labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starlane.session import materialize


def components(links: DataFrame) -> DataFrame:
    """node and comp (the smallest node reachable) for every node of ``links`` (a, b).

    Every round takes the smallest label among the neighbours and then the label
    of that label; rounds are written out, so a lost executor costs no more than
    one of them.  Nodes without links are not there.
    """
    both = materialize(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("comp")), "labels"
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(
            F.col("a").alias("node")
        ).agg(F.min("comp").alias("near"))
        lower = labels.join(near, "node").select(
            "node", F.col("comp").alias("was"), F.least("comp", "near").alias("to")
        )
        target = labels.select(F.col("node").alias("to"), F.col("comp").alias("jump"))
        after = materialize(
            lower.join(target, "to").select("node", "was", F.least("to", "jump").alias("comp")), "labels"
        )
        moved = after.where("was <> comp").limit(1).count()
        labels = after.drop("was")
        if not moved:
            return labels
