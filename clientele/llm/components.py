"""Connected components of a graph given as links between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientele.llm.staging import Staging

JUMPS = 2


def connected_components(stage: Staging, name: str, links: DataFrame,
                         known: DataFrame | None = None) -> DataFrame:
    """(node, component) for every node of a link (a, b); component: some node of it. ``known``:
    the staged result for earlier links, which ``links`` are added to; then the work is that of
    the links between different components of it.

    Every node hooks to its smallest neighbour if that is smaller; pointer jumping shortens
    the chains; then links are rewritten between the nodes they lead to, and links inside
    one are gone. Each round works on what is left, so the number of rounds grows with the
    logarithm of the longest chain. All steps are joins and partial aggregations over
    staged tables; a node with a third of all links is split by Spark's skew handling.
    """
    if known is not None:
        for end in ("a", "b"):
            of = known.select(F.col("node").alias(end), F.col("component").alias("own"))
            links = links.join(of, end, "left").withColumn(end, F.coalesce("own", end)).drop("own")
    edges = stage.put(links.where("a <> b").select(F.least("a", "b").alias("a"),
                                                   F.greatest("a", "b").alias("b")).distinct(),
                      f"{name}-edges-0")
    more = bool(edges.take(1))
    if known is not None and not more:
        return known
    labels = (edges.select(F.col("a").alias("node")).union(edges.select("b")).distinct()
              .withColumn("component", F.col("node")))
    if known is not None:
        labels = known.union(labels.join(known, "node", "left_anti"))
    labels = stage.put(labels, f"{name}-labels-0")
    step = 0
    while more:
        step += 1
        both = edges.union(edges.select("b", "a"))
        hooks = stage.put(both.groupBy("a").agg(F.min("b").alias("m"))
                          .select("a", F.least("a", "m").alias("to")), f"{name}-hooks-{step}-0")
        for jump in range(1, JUMPS + 1):
            ahead = hooks.select(F.col("a").alias("to"), F.col("to").alias("further"))
            hooks = stage.put(hooks.join(ahead, "to").select("a", F.col("further").alias("to")),
                              f"{name}-hooks-{step}-{jump}")
        labels = stage.put(
            labels.join(hooks, labels["component"] == hooks["a"], "left")
            .select("node", F.coalesce("to", "component").alias("component")),
            f"{name}-labels-{step}")
        left = hooks.select("a", F.col("to").alias("x"))
        right = hooks.select(F.col("a").alias("b"), F.col("to").alias("y"))
        edges = stage.put(edges.join(left, "a").join(right, "b").where("x <> y")
                          .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
                          .distinct(), f"{name}-edges-{step}")
        more = bool(edges.take(1))
    return labels
