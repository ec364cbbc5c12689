"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokeline.llm.tables import checkpointed, release


def components(links: DataFrame) -> DataFrame:
    """(a, b) -> node and component, the smallest node it is linked with, directly or not.

    Each round hangs the larger neighbours of a node on the smallest one, and then
    all smaller ones; rounds grow with the logarithm of the number of nodes. Least neighbours are
    found in every task before they are shuffled, and joined back; adaptive execution splits
    the edges of a node that has very many.
    """
    edges = checkpointed(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(edges)
    while state[0]:  # without links there is nothing to do
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("least", "u").alias("v"))
        small = _with_least(checkpointed(large.distinct()))
        # What hangs on the least of u: its other smaller neighbours, and u itself.
        hung = small.select("least", F.explode(F.array("u", "v")).alias("u")).where("u <> least")
        edges = checkpointed(hung.select("u", F.col("least").alias("v")).distinct())
        before, state = state, _state(edges)
        release(edges.sparkSession)
        if before == state:
            break
    own = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(own)


def _with_least(edges: DataFrame) -> DataFrame:
    """Adds the least v of each u."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u")


def _state(edges: DataFrame) -> tuple:
    """Tells whether a round changed any edge."""
    mark = F.xxhash64("u", "v").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())
