"""Connected components of a graph given as an edge table.

Alternates two steps until nothing changes: each node hands its larger neighbours to the smallest
one (large star), then each node hands its smaller neighbours to the smallest one (small star).
The edge table never grows; the number of rounds grows with the logarithm of the longest path.
Every round is one aggregation and one equi-join, so a node with very many edges is combined map-side and
split by adaptive execution. Each round's table is kept in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestride.llm.common import checkpointed


def _to_smallest(rows: DataFrame, larger_only: bool) -> DataFrame:
    """Edges (a, b), a > b, from each neighbour to the smallest node around ``u``."""
    least = rows.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = rows.join(least, "u")
    if larger_only:
        kept = joined.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        kept = joined.where(F.col("v") != F.col("m")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        kept = kept.union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return kept.where("a > b").distinct()


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b: long) to (node, component): the smallest node each node can reach.

    Nodes without an edge do not appear; loops and repeated edges are ignored, as are null ends.
    """
    now = edges.where("a is not null and b is not null and a != b")
    now = checkpointed(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).union(now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = _to_smallest(both, True)
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        now = checkpointed(_to_smallest(down, False))
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component"))
            ).distinct()
        before = state
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
