"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.llm.common import stored



def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every end of an edge; ``edges`` has columns ``a`` and ``b``.

    Every node points at its smallest neighbour, pointers are followed until they end in a root, and edges between
    different roots are the input of the next round. Each round leaves at most half of the nodes of a component, so the
    number of rounds grows with the logarithm of the largest component. Aggregates combine before the shuffle and joins
    can be split by rows, so a node with very many edges is no hot group. Nothing is collected; every round is a stored
    table. Edges with a null end and loops are ignored.
    """
    edges = edges.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    found: DataFrame | None = None
    while not edges.isEmpty():
        roots = _roots(edges)
        if found is None:
            found = roots
        else:
            up = roots.select(F.col("node").alias("component"), F.col("component").alias("up"))
            found = stored(found.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component")), "cc-found")
        a = roots.select(F.col("node").alias("a"), F.col("component").alias("ra"))
        b = roots.select(F.col("node").alias("b"), F.col("component").alias("rb"))
        left = edges.join(a, "a").join(b, "b").filter(F.col("ra") != F.col("rb"))
        edges = stored(left.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "cc-edges")
    return found if found is not None else edges.select(F.col("a").alias("node"), F.col("b").alias("component"))


def _roots(edges: DataFrame) -> DataFrame:
    """Follow every node's pointer to its smallest neighbour until it ends."""
    ends = edges.select("a", F.col("a").alias("b")).unionByName(edges).unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pointers = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component")), "cc-pointers")
    while True:
        nexts = pointers.select(F.col("node").alias("component"), F.col("component").alias("next"))
        moved = stored(pointers.join(nexts, "component").select("node", F.col("next").alias("component"), (F.col("next") != F.col("component")).alias("moved")), "cc-pointers")
        pointers = moved.select("node", "component")
        if moved.filter("moved").isEmpty():
            return pointers
