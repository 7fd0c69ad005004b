"""Connected components of a stored edge table: smallest label with pointer jumping, one table per round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallycast.llm.common import stored


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node in ``edges`` (two long columns u, v): the smallest node that it reaches.

    Each round takes the smallest label among the neighbours, then the label's
    own label, and is written to the shared folder; the rounds grow with the
    logarithm of a component's diameter.  Minima are aggregated before the
    shuffle, so a hub costs no more than its edges.  Null ends are ignored;
    an empty table gives no rows.
    """
    both = edges.where("u IS NOT NULL AND v IS NOT NULL").selectExpr("u AS a", "v AS b")
    both = stored(both.unionByName(both.selectExpr("b AS a", "a AS b")).distinct(), "edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b")).select("node", F.least("node", "b").alias("label")), "labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hop = labels.select(F.col("node").alias("mid"), F.col("label").alias("far"))
        after = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        after = after.join(hop, "mid").select("node", "old", F.least("mid", "far").alias("label"))
        after = stored(after, "labels")
        labels = after.select("node", "label")
        if after.where("label <> old").isEmpty():
            return labels
