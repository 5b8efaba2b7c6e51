"""Connected components of a link table, by contraction.

A round gives every node the smallest of itself and its neighbours, puts these
labels in place of the links' ends and keeps the distinct links whose ends still
differ.  What is settled leaves the table: a link inside a class is gone after the
round that joins its ends, and a star of any size is one round's work.  The smallest
node of a component always keeps itself, so it is what remains.  Nodes are hashes, so
falling chains of neighbours are short and a round leaves a fraction of the nodes that
doesn't depend on their number; rounds grow with its logarithm.

The rounds' labels are written, each a table of the nodes that changed, and followed
from the last to the first.  Every step is a join or an aggregate; nothing comes to the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumenflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for the nodes of ``links(a, b)``; ``comp`` is the smallest
    node reached."""
    links = materialize(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .where("a <> b").distinct(), "links")
    rounds = []
    while not links.isEmpty():
        ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        labels = materialize(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low"))
                             .select("node", F.least("node", "low").alias("comp")), "labels")
        rounds.append(labels)
        left, right = (labels.select(F.col("node").alias(c), F.col("comp").alias(f"_{c}")) for c in "ab")
        links = materialize(links.join(left, "a").join(right, "b")
                            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
                            .where("a <> b").distinct(), "links")
    if not rounds:
        return links.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    settled = rounds.pop()
    while rounds:
        # of a round's nodes, the labels that the next round changed
        far = settled.where("node <> comp").select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        settled = rounds.pop().join(far, "comp", "left").select("node", F.coalesce("far", "comp").alias("comp"))
    return materialize(settled, "components")
