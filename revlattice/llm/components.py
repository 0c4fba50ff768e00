"""Connected components by least labels, in DataFrame steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from revlattice.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node that links reach.

    Each round takes the least label of the neighbours and then the label's own label, so paths halve; rounds are written
    tables and end when nothing changes.
    """
    edges = edges.select("a", "b").filter("a <> b")
    both = written(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
    labels = written(labels, "labels")
    while True:
        around = both.join(labels.select(F.col("node").alias("b"), "root"), "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        lowered = labels.join(around, "node").select("node", F.least("root", "near").alias("low"), F.col("root").alias("old"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("next"))
        stepped = written(lowered.join(jump, "low", "left").select("node", F.least("low", "next").alias("root"), "old"), "labels")
        labels = stepped.select("node", "root")
        if stepped.filter("root <> old").isEmpty():
            return labels
