"""Connected components by repeated joins, every round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """Rows (node, label) of the nodes of ``edges`` (a, b): the least node of the component.

    A round takes the least label around each node and then the label of that label, so chains shorten by half.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("label").alias("near"))
        hop = labels.join(near, labels["node"] == near["a"]).select("node", "label", F.least("label", "near").alias("less"))
        up = labels.select(F.col("node").alias("less"), F.col("label").alias("top"))
        new = materialize(hop.join(up, "less").select("node", F.col("label").alias("old"), "top"), "labels")
        labels = new.select("node", F.col("top").alias("label"))
        if not new.filter("old <> top").limit(1).count():
            return labels
