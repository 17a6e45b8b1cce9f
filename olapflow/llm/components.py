"""Connected components by alternating star contractions, all rounds as joins.

Every round hangs nodes on smaller neighbours (large stars, then small stars) until each
component is one star around its smallest node. A round moves as many edges as there are
nodes at most, and the number of rounds grows with the logarithm of the longest path.
Rounds are written to the shared folder, so a lost executor costs one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from olapflow.llm.base import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    )
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    hung = down.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    return hung.union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """Edges (``a``, ``b``; long, any order, repeats and self-loops allowed) -> ``node``,
    ``root`` for every node of a component of two or more, root being its smallest node."""
    now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    state = _state(now)
    while state[0]:
        now = stored(_small_star(_large_star(now)), "edges")
        if (after := _state(now)) == state:
            break
        state = after
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return stars.union(stars.select(F.col("root").alias("node"), "root").distinct())
