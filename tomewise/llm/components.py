"""Connected components by hooking and contraction: each round every vertex points to its least neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tomewise.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """(v, root) for every vertex of the edges (a, b); root is one vertex of its component.

    A round lets each vertex point to its least neighbour, follows that pointer once more, and replaces the edges by
    those between the vertices reached. Stars vanish in one or two rounds, long paths in a logarithmic number.
    Tables are stored after each round, and only their counts reach the driver. No edges give no rows.
    """
    left = store(edges.filter("a != b").select("a", "b").distinct(), "edges")
    roots = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("b"))
        parent = store(parent.select("v", F.least("v", "b").alias("p")), "parents")
        up = parent.select(F.col("v").alias("p"), F.col("p").alias("pp"))
        step = store(parent.join(up, "p").select("v", F.col("pp").alias("root")), "steps")
        if roots is None:
            roots = step
        else:
            to = step.select(F.col("v").alias("root"), F.col("root").alias("next"))
            moved = roots.join(to, "root", "left").select("v", F.coalesce("next", "root").alias("root"))
            roots = store(moved, "roots")
        for end in ("a", "b"):
            to = step.select(F.col("v").alias(end), F.col("root").alias("to"))
            rest = [c for c in ("a", "b") if c != end]
            left = left.join(to, end).select(F.col("to").alias(end), *rest)
        left = store(left.filter("a != b").select("a", "b").distinct(), "edges")
    return roots if roots is not None else left.select(F.col("a").alias("v"), F.col("b").alias("root"))
