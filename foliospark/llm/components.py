"""Connected components of an edge table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliospark.llm.common import discard, materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, component`` for every node of ``edges`` (a, b: long).

    Large-star and small-star steps hook every node to the least neighbour;
    minima are aggregates and neighbours are joined back, so no task needs all
    neighbours of a node. Each round is written to the shared folder. The
    rounds end when the edges stay as they were; ``component`` is the least
    node reachable.
    """
    edges = materialize(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").unionAll(least.select("a", F.col("m").alias("b")))
        old, edges = edges, materialize(small.distinct(), name)
        discard(old)
    # the last table stays: the result reads it
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return nodes.unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
