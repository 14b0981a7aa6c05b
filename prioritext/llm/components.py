"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prioritext.llm.tables import written


def components(links: DataFrame, name: str) -> DataFrame:
    """``(node, component)`` of every node of ``links(a, b)``; the component is its smallest node.

    Each round points every node at the smallest node of its neighbourhood
    (first over all neighbours, then over the smaller ones), which at least
    halves the depth of the trees; the links of a round are written to the
    shared folder and read again.  Minima are taken by partial aggregation, so
    a node with very many links costs one row per task.
    """
    links = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    links = written(links.filter("u <> v").distinct(), f"{name}-links")
    before = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if state == before or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                links.select("v", "v").distinct()
            )
        before = state
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), f"{name}-links")
