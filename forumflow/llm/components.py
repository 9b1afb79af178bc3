"""Connected components of a graph given as edges, by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forumflow.llm.staging import shuffled_join, staged


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): the least node it is connected to.

    Each round points nodes at the least of their neighbours, first from the larger side, then
    from the smaller one. Minimums are aggregates, so a node with very many neighbours is combined
    before the shuffle. Rounds go on until nothing changes; their number grows with the logarithm
    of the longest path.
    """
    now = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = staged(now.distinct(), "components-edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = shuffled_join(both.filter("b > a"), least, "a")
        large = large.select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = staged(large.filter("a <> b").distinct(), "components-large")
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        joined = shuffled_join(down, least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            joined.select("a", F.col("m").alias("b"))
        )
        now = staged(small.filter("a <> b").distinct(), "components-small")
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.unionByName(roots)
