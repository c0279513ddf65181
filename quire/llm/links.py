"""Connected components of an edge table, by joins alone."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.llm.common import free, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Columns node and component (the smallest node reachable) for each node of an edge.

    In a round each node hooks to the smallest of itself and its neighbours; the trees that gives are flattened by taking
    parents' parents, each time half as deep; then each tree is one node, and only edges between trees are left for the
    next round. Hooks are aggregated before their shuffle. Every step's table is written to the shared folder, so lost
    executors cost one step. Loops and repeated edges do no harm; no edges, no rows.
    """
    low, high = F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")
    left = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    left = materialize(left.where("u <> v").select(low, high).distinct(), "edges")
    found = None
    while found is None or left.limit(1).count():
        both = left.union(left.select("v", "u"))
        parent = materialize(both.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("parent")), "parents")
        while True:
            up = parent.select(F.col("node").alias("parent"), F.col("parent").alias("above"))
            higher = materialize(parent.select("node", "parent").join(up, "parent").select("node", F.col("above").alias("parent"), (F.col("above") != F.col("parent")).alias("moved")), "parents")
            free(parent)
            parent = higher
            if not higher.where("moved").limit(1).count():
                break
        if found is None:
            found = materialize(parent.select("node", F.col("parent").alias("component")), "components")
        else:
            tops = parent.select(F.col("node").alias("component"), F.col("parent").alias("top"))
            wider = materialize(found.join(tops, "component", "left").select("node", F.coalesce("top", "component").alias("component")), "components")
            free(found)
            found = wider
        named = left.join(parent.select(F.col("node").alias("u"), F.col("parent").alias("x")), "u").join(parent.select(F.col("node").alias("v"), F.col("parent").alias("y")), "v")
        merged = named.where("x <> y").select(F.col("x").alias("u"), F.col("y").alias("v"))
        merged = materialize(merged.select(low, high).distinct(), "edges")
        free(left, parent)
        left = merged
    free(left)
    return found
