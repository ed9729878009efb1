"""Connected components of a graph given by its edges, by repeated joins.

In each round every node points to the least identifier among itself and its neighbours. Pointers
are followed to their ends, two at a time, and the ends are the labels. They take the place of the nodes
on the edges: those within one label are gone, so the edges become fewer from round to round. A
node with very many edges is a grouping key with a partial minimum, never a collected list. Each
round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the least id of its component) of every end of an edge (``a``, ``b``)."""
    edges = stored(edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        # Labels that still have an edge, each with the least of its neighbours and itself.
        ends = edges.select(F.col("b").alias("id"), F.col("a").alias("to")).union(edges.select("a", "a"))
        hooks = stored(ends.groupBy("id").agg(F.min("to").alias("label"), F.lit(True).alias("moved")), "hooks")
        while not hooks.where("moved").isEmpty():
            jump = hooks.select(F.col("id").alias("label"), F.col("label").alias("root"))
            hooks = stored(
                hooks.join(jump, "label").select("id", F.col("root").alias("label"), (F.col("root") < F.col("label")).alias("moved")),
                "hooks",
            )
        hooks = hooks.select("id", "label")
        at = hooks.select(F.col("id").alias("label"), F.col("label").alias("next"))
        if labels is None:
            labels = hooks
        else:
            labels = stored(labels.join(at, "label", "left").select("id", F.coalesce("next", "label").alias("label")), "labels")
        for side in "ba":
            to = at.withColumnRenamed("label", side)
            edges = edges.join(to, side).drop(side).withColumnRenamed("next", side)
        edges = stored(
            edges.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges"
        )
    return edges.select(F.col("a").alias("id"), F.col("b").alias("label")) if labels is None else labels
