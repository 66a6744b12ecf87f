"""Connected components of a link table by alternating star contractions.

Each round points every node's larger neighbours at its smallest neighbour (large star), then its
smaller ones (small star). Rounds grow with the logarithm of a component's size, not with its
diameter, rows never exceed the links, and nothing but two numbers a round reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.session import checkpoint_dir


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u"))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return (both.where("v > u").join(least, "u")
                .select(F.col("v").alias("u"), F.col("m").alias("v")))


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"),
                                                         F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """``links`` (a, b: two nodes of any ordered type) to one row per linked node: node, root
    (the smallest node of its component). Links in either direction, repeated links and links
    of a node to itself are allowed; a null end is no link; no links give no rows."""
    checkpoint_dir(links.sparkSession)
    edges = (links.where("a <> b")
                  .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                  .distinct().checkpoint())
    seen = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == seen:
            break
        seen = now
        edges = _small_star(_large_star(edges)).checkpoint()
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(roots.select("root", "root").distinct())
