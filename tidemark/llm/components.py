"""Connected components by alternating large-star and small-star steps on an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_shared, materialize

#: Rounds after which something must be wrong: the number of rounds grows with the logarithm of a component's size.
MOST_ROUNDS = 60


def _stars(pairs: DataFrame, keep) -> DataFrame:
    """Link ends to the smallest neighbour of their node. pairs: (u, v)."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return keep(pairs.join(least, "u"))


def large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _stars(both, lambda x: x.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    links = _stars(down, lambda x: x.select("v", "m").unionByName(x.select(F.col("u").alias("v"), "m")))
    return links.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (u, v); root is the smallest node reachable.

    Self-links, repeated and reversed edges do no harm; nodes are integers. Every round is written to the shared
    folder, where nothing but its row count and a checksum is read on the driver.
    """
    table, mark = materialize(edges.filter("u <> v").distinct(), "cc-edges"), None
    for _ in range(MOST_ROUNDS):
        after = materialize(small_star(large_star(table)), "cc-edges")
        drop_shared(table)
        table = after
        now = table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == mark:
            return table.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(table.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
    raise RuntimeError("components did not settle")
