"""Connected components of a graph given as edges, by rounds of contraction.

In a round every node points to the smallest of itself and its neighbours; pointers are doubled until
they end at roots, and the edges are moved to the roots. Each node with an edge either is moved or
gains one, so at least half the nodes disappear per round. No neighbourhood is ever gathered in one task:
minima are combined on the map side, and every join has one row per key on one side, so that a hot node's
edges can be split. Each result is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfprice.plans.staging import stage


def _doubled(pointers: DataFrame) -> DataFrame:
    """``node, root`` from ``node, to`` where following ``to`` never increases."""
    while True:
        onward = pointers.select(F.col("node").alias("to"), F.col("to").alias("next"))
        jumped = stage(
            pointers.join(onward, "to", "left").select("node", "to", F.coalesce("next", "to").alias("next")), "pointers"
        )
        moved = jumped.where("next != to").isEmpty()
        pointers = jumped.select("node", F.col("next").alias("to"))
        if moved:
            return pointers.select("node", F.col("to").alias("root"))


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``): the smallest node of its component.

    NULL ends and loops are no edges; repeated edges count once; an empty table gives an empty result.
    """
    edges = stage(edges.where("a != b").select("a", "b"), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        roots = stage(_doubled(stage(least.select("node", F.least("node", "b").alias("to")), "least")), "roots")
        if labels is None:
            labels = roots
        else:
            onward = roots.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = stage(
                labels.join(onward, "root", "left").select("node", F.coalesce("next", "root").alias("root")), "labels"
            )
        at_a = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        at_b = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        moved = edges.join(at_a, "a").join(at_b, "b").where("ra != rb")
        ends = (F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b"))
        edges = stage(moved.select(*ends).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return labels
