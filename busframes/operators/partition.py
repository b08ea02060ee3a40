"""Ordering, previews and partitioned layouts."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: rows of one id or range that one task sorts
TASK_ROWS = 1 << 20


def cluster_by_id(decoded: DataFrame, partitions: int | None = None, slices: int = 1) -> DataFrame:
    """Hash-partition by id and sort each partition by (id, ts): runs of one
    id per partition for writers that prepare a statement per id. A hot id
    stays in one task unless its rows are dealt to ``slices`` by their ts;
    ``range_by_id_ts`` splits it instead."""
    parts = [partitions] if partitions else []
    by = ["id"] if slices < 2 else ["id", F.pmod(F.xxhash64("ts"), F.lit(slices))]
    return decoded.repartition(*parts, *by).sortWithinPartitions("id", "ts")


def range_by_id_ts(decoded: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range-partition by (id, ts): contiguous id/time runs, and a hot id is
    split over as many tasks as its volume needs."""
    parts = [partitions] if partitions else []
    return decoded.repartitionByRange(*parts, "id", "ts").sortWithinPartitions("id", "ts")


def ensure_parallelism(df: DataFrame, minimum: int | None = None) -> DataFrame:
    """Round-robin repartition only when the input has fewer partitions than
    the cluster can run at once (e.g. one unsplittable file or a single
    parquet row group). A large scan already has many splits and passes
    through untouched, so no shuffle is added at scale."""
    target = minimum or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)


def preview(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First ``n`` rows in a total order (top-k: partial sort per task, then
    one merge of k rows per task)."""
    return df.orderBy(*order).limit(n)


def write_partitioned(df: DataFrame, path: str, by: list[str], fmt: str = "parquet",
                      mode: str = "overwrite", options: dict | None = None,
                      within: list[str] | None = None, observation=None) -> None:
    """One pass, one directory per key value (``key=value``), readable with
    partition pruning. Rows are rebalanced on the keys: tasks write few, large
    files ordered by ``within``, and adaptive execution splits a hot key by
    its size. Nothing is sampled, so the upstream runs once."""
    if within is None:
        within = ["ts"] if "ts" in df.columns else []
    cols = [*by, *within]
    clustered = df.hint("rebalance", *by).sortWithinPartitions(*cols)
    if observation is not None:
        clustered = clustered.observe(observation, F.count(F.lit(1)).alias("delivered"))
    writer = clustered.write.mode(mode).format(fmt).partitionBy(*by)
    if options:
        writer = writer.options(**options)
    writer.save(path)


def persist(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> DataFrame:
    return df.persist(level)


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))
