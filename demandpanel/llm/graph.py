"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandpanel.sources.checkpoints import ensure_checkpoint_dir


def _to_minimum(edges: DataFrame, smaller_only: bool) -> DataFrame:
    """Link the neighbours of every node (and the node) to the least of them."""
    if smaller_only:
        arcs = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    else:
        arcs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = arcs.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    both = arcs.join(low, "a")
    if smaller_only:
        out = both.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
    else:
        out = both.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the least node reachable, for every node of ``edges (a, b)``.

    Large-star and small-star steps alternate until nothing changes, a number of rounds that
    grows with the logarithm of the longest path. Each step is a partial aggregate and a join,
    so a node with very many links is split like any skewed join key.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    edges = edges.where("a <> b").distinct().checkpoint()
    state = None
    while True:
        edges = _to_minimum(_to_minimum(edges, False), True).checkpoint()
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return nodes.unionByName(roots)
