"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import kept_table


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) for every node of the edges a-b.

    Labels fall to the smallest among the neighbours and then to the label's own label, until none changes. Each round is written to the
    shared folder. Rows with a null end are left out.
    """
    known = edges.where("a is not null and b is not null and a != b")
    # kept before it is turned round: edges that are found anew for the other direction need not be the same ones
    once = kept_table(known.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "components-edges")
    both = once.unionAll(once.select(F.col("b"), F.col("a")))
    # the first round needs no labels
    labels = kept_table(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("l")).select("node", F.least("node", "l").alias("label")), "components-labels")
    while True:
        low = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("low"))
        fallen = labels.join(low, F.col("node") == F.col("a")).select("node", "label", F.least("label", "low").alias("next"))
        heads = labels.select(F.col("node").alias("head"), F.col("label").alias("beyond"))
        jumped = fallen.join(heads, F.col("next") == F.col("head")).select("node", F.least("next", "beyond").alias("next"), "label")
        step = kept_table(jumped, "components-labels")
        changed = step.where("next != label").limit(1).count()
        labels = step.select("node", F.col("next").alias("label"))
        if not changed:
            return labels.withColumnRenamed("label", "component")
