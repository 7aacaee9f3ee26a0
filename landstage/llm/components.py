"""Connected components of a graph given as pairs of ids, by hooking and contraction.

Every round hooks each node to its smallest neighbour, follows the hooks to their
roots and replaces edges by edges between roots.  Each round at least halves the
nodes that still have edges, so stars take one round and long paths a logarithm
of their length.  Nothing is collected; every round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landstage.llm.common import materialise


def connected_components(edges: DataFrame) -> DataFrame | None:
    """(node, root) for every node of ``edges`` (a, b); root is the smallest id reachable.

    Null ids and self loops are ignored.  None if there is no edge at all.
    """
    edges = materialise(edges.where("a <> b").select("a", "b").distinct(), "cc-edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        hooks = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("root")), "cc-hooks")
        moving = True
        while moving:
            to = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
            jumped = materialise(hooks.join(to, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "cc-jump")
            hooks, moving = jumped.select("node", "root"), not jumped.where("moved").isEmpty()
        up = hooks.select(F.col("node").alias("root"), F.col("root").alias("up"))
        if roots is None:
            roots = hooks
        else:
            roots = materialise(roots.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root")), "cc-roots")
        ra = hooks.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        rb = hooks.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = materialise(edges.join(ra, "a").join(rb, "b").where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-edges")
    return roots
