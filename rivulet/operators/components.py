"""Connected components of a table of links, by DataFrame operations alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import drop_last, materialize


def components(links: DataFrame) -> DataFrame:
    """(node, root): the least node of each linked node's component.

    ``links`` has columns a and b of one type.  A round gives each node the
    least label among its neighbours', hangs the node's former label below it,
    and follows labels once; rounds end when no label changes.  Each round's
    labels are a table in the shared folder, which the next one's replaces.  A label
    goes with its node from shuffle to shuffle, so a round has few of them.
    """
    both = F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    edges = materialize(links.select(both).distinct(), "edges")

    def followed(hung: DataFrame) -> DataFrame:
        """node, root and whether that changed, of rows with node, next and was."""
        step = hung.join(hung.select(F.col("node").alias("parent"), F.col("next").alias("above")), F.col("next") == F.col("parent"), "left")
        root = F.least("next", "above")
        return step.select("node", root.alias("root"), (root != F.col("was")).alias("changed"))

    # At first each node is its own label, so there is nothing to look up.
    least = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("next"))
    labels = materialize(followed(least.select("node", F.least("node", "next").alias("next"), F.col("node").alias("was"))), "labels").select("node", "root")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "root"), "b").select(F.col("a").alias("node"), F.col("root").alias("next"), F.lit(None).alias("was"))
        now = near.unionByName(labels.select("node", F.col("root").alias("next"), F.col("root").alias("was"))).groupBy("node").agg(F.min("next").alias("next"), F.max("was").alias("was"))
        own, below = F.struct("node", "next", "was"), F.struct(F.col("was").alias("node"), "next", F.lit(None).alias("was"))
        hung = now.select(F.inline(F.array(own, below))).groupBy("node").agg(F.min("next").alias("next"), F.max("was").alias("was"))
        new = materialize(followed(hung), "labels")
        labels = new.select("node", "root")
        changed = bool(new.where("changed").take(1))
        drop_last(links.sparkSession, 1)
        if not changed:
            drop_last(links.sparkSession, 1)  # the edges
            return labels
