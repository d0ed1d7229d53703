"""Connected components of a graph whose edges do not fit one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from emberlink.llm.common import cut_lineage


def _largest_stars(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = cut_lineage(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    hung = both.where("v > u").join(least, "u")
    return hung.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()


def _smallest_stars(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
    hung = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(``node``, ``component``) for every node with an edge (``a``, ``b``); a component's id is its smallest node.

    Alternating stars: each round shortens the way to the smallest node, and the number of rounds
    grows with the logarithm of the number of nodes. Minima are taken before the shuffle, so a
    node with very many neighbours sends one row a task, and joins on it can be split. Every
    round is written to the shared folder; only its row count and checksum reach the driver.
    Null ends and loops are no edges.
    """
    larger, smaller = F.greatest("a", "b"), F.least("a", "b")
    state = edges.where("a is not null and b is not null and a <> b").select(larger.alias("u"), smaller.alias("v")).distinct()
    state, before = cut_lineage(state, label), None
    while True:
        seen = state.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == before or not seen[0]:
            break
        before = seen
        state = cut_lineage(_smallest_stars(_largest_stars(state)), label)
    roots = state.select(F.col("v").alias("node")).distinct()
    return state.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.withColumn("component", F.col("node")))
