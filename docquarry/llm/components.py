"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docquarry import scratch


def stars(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (columns a and b), root being the smallest node of its component.

    Each round is two aggregations and two joins on the node. Rounds double the
    reach of a root, so they number about the logarithm of the component's
    diameter. A busy node's rows are pre-aggregated before the shuffle. The
    minima are written to the shared folder before they are joined back, so that
    both sides of a join are dealt for it alone and the engine can split a busy
    node's rows over several tasks. Edges with a null end or equal ends are ignored.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    now = scratch.materialize(now, "edges")
    state = None
    for _ in range(most_rounds):
        both = now.union(now.select("v", "u"))
        least = scratch.materialize(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "minima")
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.materialize(large.where("u > v"), "edges")
        least = scratch.materialize(large.groupBy("u").agg(F.min("v").alias("m")), "minima")
        small = large.join(least, "u")
        small = small.select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")).select("e.u", F.col("e.m").alias("v"))
        now = scratch.materialize(small.where("u > v").distinct(), "edges")
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == state or not seen[0]:
            break
        state = seen
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select("v", "v").distinct())
