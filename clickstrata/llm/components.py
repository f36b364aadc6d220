"""Connected components by alternating large-star and small-star steps.

Both steps only ever replace a node's neighbours by their minimum, so the edge
list shrinks towards one star per component in a number of rounds that grows
with the logarithm of its size.  Each round is written to the shared folder,
which cuts the lineage; nothing but an edge count and a checksum reaches the
driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickstrata.llm.common import Scratch


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    moved = both.filter("b > a").join(least, "a").select("b", "m")
    return moved.select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").filter("b > m").select("b", "m")
    return (
        moved.union(least.select("a", "m"))
        .toDF("a", "b")
        .filter("a != b")
        .distinct()
    )


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge between different nodes (a, b).

    ``root`` is the smallest node that can be reached; it has a row itself.
    """
    scratch = Scratch(edges.sparkSession, "components")
    pairs = edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
    pairs = scratch.store(pairs.filter("a != b").distinct(), "round-0")
    last, n = None, 0
    while True:
        state = pairs.agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")
        ).first()
        if state.n == 0 or state == last:
            break
        last, n = state, n + 1
        pairs = scratch.store(_small_star(_large_star(pairs)), f"round-{n}")
        scratch.drop(f"round-{n - 1}")
    members = pairs.toDF("node", "root")
    roots = members.select(F.col("root").alias("node"), "root").distinct()
    return members.union(roots)
