"""Connected components of a stored edge table, by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stage


def connected_components(links: DataFrame) -> DataFrame:
    """``links``: ``a``, ``b`` (long).  Returns ``node``, ``comp`` for every
    node of a link, ``comp`` being the smallest node of its component.

    Each round every component with a smaller neighbour hooks onto its
    smallest one, chains of hooks are shortened by pointer jumping, and edges
    inside a component go.  Rounds are stored in the shared folder."""
    ends = links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).filter("hi <> lo").distinct()
    edges = stage(ends, "cc-edges")
    comp = stage(edges.select(F.col("hi").alias("node")).union(edges.select("lo")).distinct()
                 .withColumn("comp", F.col("node")), "cc-nodes")
    while not edges.isEmpty():
        hooks = stage(edges.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("up")), "cc-hooks")
        while True:  # up to a root, which has no hook
            above = hooks.select(F.col("node").alias("up"), F.col("up").alias("further"))
            jumped = stage(hooks.join(above, "up", "left").select(
                "node", F.coalesce("further", "up").alias("up"), F.col("further").isNotNull().alias("moved")), "cc-jump")
            hooks = jumped.drop("moved")
            if jumped.filter("moved").isEmpty():
                break
        root = hooks.select(F.col("node").alias("comp"), "up")
        comp = stage(comp.join(root, "comp", "left").select("node", F.coalesce("up", "comp").alias("comp")), "cc-nodes")
        hi, lo = (hooks.select(F.col("node").alias(c), F.col("up").alias(f"{c}_up")) for c in ("hi", "lo"))
        moved = (edges.join(hi, "hi", "left").join(lo, "lo", "left")
                 .select(F.coalesce("hi_up", "hi").alias("x"), F.coalesce("lo_up", "lo").alias("y")).filter("x <> y")
                 .select(F.greatest("x", "y").alias("hi"), F.least("x", "y").alias("lo")).distinct())
        edges = stage(moved, "cc-edges")
    return comp
