"""Connected components of an edge table, by alternating large-star and
small-star steps (the number of rounds grows with the logarithm of the
diameter). Each step is one exchange; a node's neighbours pass a window in
sorted runs, which Spark spills, and are never gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from busframes.session import checkpoint_base


def _fingerprint(edges: DataFrame):
    # a sum of longs would overflow beyond 16 million edges
    mixed = F.pmod(F.xxhash64("a", "b"), F.lit(1 << 40)).cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(mixed)).first())


def _with_least(edges: DataFrame) -> DataFrame:
    """Distinct edges (a, b) with the least b of each a."""
    return (edges.repartition("a").dropDuplicates(["a", "b"])  # the rows of an a are together: no second exchange
            .withColumn("m", F.min("b").over(Window.partitionBy("a"))))


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) of every node of the edges (a, b); component is the
    least node reachable. Loops, repeated and null edges don't matter."""
    checkpoint_base(edges.sparkSession)
    edges = (edges.select("a", "b").filter("a is not null and b is not null and a <> b")
             .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).checkpoint())
    last = None
    while (now := _fingerprint(edges)) != last:
        last = now
        # large star: every larger neighbour of a node joins the least node around it
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = (_with_least(both).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).filter("a <> b"))
        # small star: a node and its smaller neighbours join the least of them
        edges = (_with_least(large).select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                 .filter("a <> b").checkpoint())
    rows = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return rows.unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
