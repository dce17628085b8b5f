"""Connected components of an edge table by hooking and pointer jumping.

Every round hooks each node to its smallest smaller neighbour, shortens the
resulting chains, and contracts the edges to the new labels, so the edge table
shrinks from round to round. Nothing but a count comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nbsieve.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of ``edges(a, b)``; label: smallest id in
    the node's component. No edges: no rows."""
    hi, lo = F.greatest("a", "b"), F.least("a", "b")
    live = stored(edges.filter("a <> b").select(hi.alias("x"), lo.alias("y")).distinct(), "edges")
    labels = live.select(F.explode(F.array("x", "y")).alias("node")).distinct() \
                 .withColumn("label", F.col("node"))
    while not live.isEmpty():
        hook = live.groupBy("x").agg(F.min("y").alias("to"))
        for _ in range(2):
            jump = hook.select(F.col("x").alias("to"), F.col("to").alias("further"))
            hook = stored(hook.join(jump, "to", "left")
                          .select("x", F.coalesce("further", "to").alias("to")), "hooks")
        root = lambda c: (hook.select(F.col("x").alias(c), F.col("to").alias(f"{c}_to")))
        labels = stored(labels.join(root("label"), "label", "left")
                        .select("node", F.coalesce("label_to", "label").alias("label")), "labels")
        moved = live.join(root("x"), "x", "left").join(root("y"), "y", "left").select(
            F.coalesce("x_to", "x").alias("a"), F.coalesce("y_to", "y").alias("b"))
        live = stored(moved.filter("a <> b").select(hi.alias("x"), lo.alias("y")).distinct(),
                      "edges")
    return labels
