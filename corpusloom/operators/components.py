"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.storage import discard, materialize


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node with a link to another; component is the smallest node reachable.

    ``links`` has two columns of one orderable type, in any direction, with repeats and loops allowed. Each round is
    two keyed aggregations and joins, written to the shared folder; rounds grow with the logarithm of the diameter.
    """
    a, b = links.columns[:2]
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v and u is not null and v is not null")
    edges = materialize(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    before, old = None, edges
    for _ in range(most_rounds):
        # large star: every larger neighbour points to the smallest of the neighbourhood
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        edges = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: the smaller neighbours and the node itself point to the smallest of them
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        joined = edges.join(least, "u")
        edges = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        edges = materialize(edges, "stars")
        discard(edges.sparkSession, old)
        old = edges
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
