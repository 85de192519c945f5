"""Connected components of a graph given as edges, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from llm.frames import materialise


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, root)` for every node in `edges` (columns `a`, `b` of one orderable type); root is the smallest node reached.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest
    neighbour, and then its smaller ones. Each keeps the components and shortens paths; the number of
    rounds grows with the logarithm of the longest path. A node with very many neighbours costs no
    more than its edges, as the minimum is aggregated before the shuffle and joined back. Null ends
    and self links are left out. No edges: no rows.
    """
    links = materialise(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = None
    while True:
        links = _star(links, larger=True)
        links = materialise(_star(links, larger=False))
        state = links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if state == before:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
                links.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            )
        before = state


def _star(links: DataFrame, larger: bool) -> DataFrame:
    """One step: for each node, its larger (or else its smaller) neighbours get a link to its least neighbour or itself."""
    both = links.select("a", "b")
    if larger:
        both = both.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least"))
    least = least.select(F.col("a").alias("hub"), F.least("a", "least").alias("least"))
    joined = both.join(least, both["a"] == least["hub"])
    moved = joined.where(F.col("b") > F.col("a") if larger else F.col("b") <= F.col("a"))
    moved = moved.select(F.col("b").alias("a"), F.col("least").alias("b"))
    if not larger:
        moved = moved.unionByName(least.select(F.col("hub").alias("a"), F.col("least").alias("b")))
    return moved.where(F.col("a") != F.col("b")).distinct()
