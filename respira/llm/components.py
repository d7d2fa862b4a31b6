"""Connected components of an edge table by alternating star contraction, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.llm.common import store


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) for every node of the edges ``a, b`` (two longs).

    Every round links each node's larger neighbours to its smallest one, then its smaller ones, so long paths shrink
    geometrically. Rounds keep at most as many edges as there were; minima are taken by partial aggregation, and a node
    with very many neighbours meets them in joins that adaptive execution splits. Loops and nulls are ignored.
    """
    e = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct()
    e, before = store(e), None
    while True:
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            break
        before = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = store(large.filter("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
        e = store(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
