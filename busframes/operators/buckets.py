"""Frames stored in buckets of their id, so that later joins and group-bys by
id need no exchange.

A hash partitioning by id puts a hot id into one bucket. With ``slices`` above
1 a bucket belongs to (id, slice), where the slice comes from the frame's time
stamp: a hot id then fills that many buckets. Aggregations go by (id, slice)
without an exchange and add up the slices of an id; joins replicate the small
side to the slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def slice_of(ts: str | Column, slices: int) -> Column:
    return F.pmod(F.xxhash64(ts), F.lit(slices)).cast("int")


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, slices: int = 1) -> DataFrame:
    """Store frames (id, ts, ...) as table ``table`` at ``path`` (shared), in
    ``buckets`` buckets sorted by id and time; column ``slice`` is 0 to
    slices - 1. Each task writes one bucket's rows. Returns the table."""
    keys = ["id", "slice"] if slices > 1 else ["id"]
    rows = df.withColumn("slice", slice_of("ts", slices))
    (rows.repartition(buckets, *keys).write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy("id", "ts").saveAsTable(table))
    return df.sparkSession.table(table)


def totals_by_id(stored: DataFrame, *aggs: tuple[str, Column, str]) -> DataFrame:
    """``aggs``: (name, aggregate, function that adds slices up: sum, min or
    max). Grouped within the buckets first; what crosses tasks is one row per
    (id, slice)."""
    parts = stored.groupBy("id", "slice").agg(*[a.alias(n) for n, a, _ in aggs])
    return parts.groupBy("id").agg(*[getattr(F, how)(n).alias(n) for n, _, how in aggs])


def join_by_id(stored: DataFrame, side: DataFrame, slices: int = 1) -> DataFrame:
    """Stored frames joined with a smaller table on ``id``: the frames stay in
    their buckets, only the other side is dealt out (once per slice)."""
    if slices == 1:
        return stored.join(side.hint("shuffle_hash"), "id")
    each = side.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    return stored.join(each.hint("shuffle_hash"), ["id", "slice"])


def drop_bucketed(spark: SparkSession, table: str) -> None:
    """Forget the table; its files stay where they are."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
