"""Connected components of a link table, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourgrid.session import materialize


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, label) with the smallest node of each component, for links (a, b) of long ids.

    A round takes the smallest label among the neighbours and then the label of that label, so
    distances halve. Minima are combined before the shuffle; the joins are plain sort-merge
    joins of written tables, whose hot keys adaptive execution splits. Stops when nothing changes.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels")
    for _ in range(rounds):
        near = both.join(labels, both.a == labels.node).groupBy(F.col("b").alias("n")).agg(F.min("label").alias("near"))
        step = materialize(labels.join(near, labels.node == near.n, "left").select("node", "label", F.least("label", "near").alias("new")), "labels")
        over = step.select(F.col("node").alias("n"), F.col("new").alias("jump"))
        labels = materialize(
            step.join(over, step.new == over.n, "left").select("node", F.least("new", "jump").alias("label"), (F.least("new", "jump") < F.col("label")).alias("moved")),
            "labels",
        )
        if not labels.filter("moved").limit(1).count():
            return labels.select("node", "label")
        labels = labels.select("node", "label")
    raise RuntimeError(f"no fixed point after {rounds} rounds")
