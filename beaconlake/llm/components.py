"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconlake.session import staged

MOST_ROUNDS = 60


def connected(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root): the least node that each node of the edges is connected with, itself included.

    Alternating stars: each node links its larger neighbours, then its smaller ones, to the least of them, until every
    node but the roots has one edge, to its root. Rounds grow with the logarithm of the longest path.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    links = staged(links, "links")
    before = None
    for _ in range(MOST_ROUNDS):
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select("u", "v", "m")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        links = staged(small.where("u <> v").distinct(), "links")
        # `hash` of an edge, summed: equal in two rounds only when nothing changed.
        now = links.select(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == before or now["n"] == 0:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
