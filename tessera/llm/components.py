"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialise


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a long, b long) → (node, root): every node with the smallest node it is connected to.

    Each round hangs neighbours on the smallest node around them, first the
    larger ones, then the smaller ones; it ends when a round changes nothing,
    after O(log² n) rounds. A hub's neighbours are reduced with a
    map-side minimum and meet it again in a join that AQE can split, so no
    task holds a whole component. Edges between a node and itself and null
    ends are ignored.
    """
    kept = edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    kept = materialise(kept, "edges")
    n = kept.count()
    while n:
        both = kept.unionByName(kept.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialise(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "large")
        least = materialise(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = (large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        small = materialise(small, "edges")
        rows = small.count()
        if rows == n and small.join(kept, ["u", "v"], "left_anti").isEmpty():
            break
        kept, n = small, rows
    return kept.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        kept.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
