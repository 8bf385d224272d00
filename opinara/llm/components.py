"""Connected components of a link table, in joins and counts that keep no neighbourhood in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opinara.llm.frames import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node with a link in ``a, b``; a component is its smallest node.

    Alternates two rewirings (large star, small star): every node hands the smallest node of its
    neighbourhood to its larger, then to its smaller neighbours. Chains shrink to stars in few rounds.
    Minima are combined per task; a hub with very many links only meets a join, which can be split.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    edges = materialize(edges.filter("u <> v").distinct())
    before = None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = materialize(small.filter("u <> v").union(lowest).distinct())
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(edges.select("v", "v").distinct())
