"""Connected components of an edge table by alternating large-star and small-star steps (Kiveris et al. 2014)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import written


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node of its component. Loops and repeats may occur.

    Rounds are written to the shared folder. A node of high degree is met by sums made before shuffles and joins that can be split.
    """
    edges = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "components")
    loops = edges.filter("u = v").select(F.col("u").alias("node"))
    state, now = None, edges.filter("u <> v")
    for _ in range(most_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        mins = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(mins, "u").select(F.explode(F.array(F.struct("v", F.col("m").alias("w")), F.struct(F.col("u").alias("v"), F.col("m").alias("w")))).alias("e"))
        now = written(small.select(F.col("e.v").alias("u"), F.col("e.w").alias("v")).filter("u <> v").distinct(), "components")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state:
            roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            heads = now.select(F.col("v").alias("node"), F.col("v").alias("root"))
            alone = loops.join(now.select(F.col("u").alias("node")).unionByName(now.select(F.col("v").alias("node"))), "node", "left_anti").select("node", F.col("node").alias("root"))
            return roots.unionByName(heads).unionByName(alone).distinct()
        state = seen
    raise RuntimeError(f"components didn't settle in {most_rounds} rounds")
