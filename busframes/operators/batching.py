"""Skew-safe row numbering within a key, for fixed-size write batches.

``row_number() over (partition by key order by ...)`` puts a whole key in one
task; one hot message can hold a third of the rows. Instead every key is cut
into ranges of its leading order column, as many as its rows need, from a
quantile sketch per key (``ranges``); a window numbers the rows of each
(key, range), and a small table of rows before each range of its key corrects
the numbers.

The cuts are fixed before any row is numbered, so the same row falls into the
same range in every evaluation: nothing of the input is stored. It is read
three times, twice for its key and leading order column alone (the sketch, the
counts; where every key fits one range, the sketch only), so columns that are
dear to make (a decode) are made once. Stage a trace that is dear to parse
(``staged``).
Rows with one key and one value of the leading order column stay together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from busframes.operators.ranges import MAX_CUTS, cuts_of, with_cuts_below

KEY_CUTS = 8191          # of one key
RANGE_ROWS = 1 << 18     # rows of a range, unless that makes more than MAX_CUTS ranges
MERGERS = 8              # tasks that merge the sketches of one key


def _same(a: DataFrame, b: DataFrame, key: list[str], prefix: str):
    cond = F.lit(True)
    for k in key:
        cond &= a[k].eqNullSafe(b[f"{prefix}{k}"])
    return cond


def staged(df: DataFrame, name: str) -> DataFrame:
    """The rows written once to the shared folder and read back from there."""
    from busframes.session import shared_dir

    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _key_stats(df: DataFrame, key: list[str], lead) -> DataFrame:
    """Per key its rows (``_rows``) and KEY_CUTS cuts of ``lead`` (``_all``).

    Every task of the input sends a sketch per key, so one task can't merge
    them all: ``MERGERS`` tasks per key merge a share each, and the shares'
    cuts, thinned so that each stands for as many rows, give those of the key."""
    parts = (df.select(*key, lead.alias("_lead"), F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("_part"))
             .groupBy(*key, "_part").agg(F.count(F.lit(1)).alias("_rows"), cuts_of(F.col("_lead"), KEY_CUTS + 1).alias("_all")))
    parts = parts.withColumn("_total", F.sum("_rows").over(Window.partitionBy(*key)))
    n = F.ceil(F.col("_rows") * F.least(F.lit(KEY_CUTS + 1), F.col("_total")) / F.col("_total")).cast("int")
    points = F.transform(F.sequence(F.lit(1), n), lambda i: F.get(
        "_all", F.greatest(F.lit(0), F.floor(i.cast("bigint") * (KEY_CUTS + 1) / (n + 1)).cast("int") - 1)))
    return (parts.select(*key, "_total", F.explode_outer(points).alias("_point")).groupBy(*key)
            .agg(F.max("_total").alias("_rows"), cuts_of(F.col("_point"), KEY_CUTS + 1).alias("_all")))


def rank_within_key(df: DataFrame, key: list[str], order: list[str],
                    partitions: int | None = None, col: str = "rank") -> DataFrame:
    """Add ``col`` = 0-based rank of the row inside its key by ``order``.

    ``key + order`` must be a total order up to identical rows, ``order[0]`` a
    whole number. ``partitions``: ranges of the whole table (default: by its
    rows)."""
    from busframes.session import checkpoint_base

    checkpoint_base(df.sparkSession)
    lead = F.col(order[0]).cast("bigint")
    number = F.row_number().over(Window.partitionBy(*key, "_range").orderBy(*order)) - 1
    stats = _key_stats(df, key, lead).checkpoint()
    total = stats.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    ranges = min(MAX_CUTS, partitions or max(1, total // RANGE_ROWS))
    n = F.least(F.lit(KEY_CUTS + 1), F.ceil(F.col("_rows") / max(1, total // ranges))).cast("int")
    most = int(stats.agg(F.max(n)).first()[0] or 1)
    if most == 1:
        return df.withColumn("_range", F.lit(0)).withColumn(col, number.cast("bigint")).drop("_range")
    # at most MAX_CUTS cuts and a row per key: a broadcast of bounded size beside the dictionary's messages
    cuts = F.when((n > 1) & F.col("_all").isNotNull(), F.transform(
        F.sequence(F.lit(1), n - 1), lambda i: F.get("_all", F.floor(i.cast("bigint") * (KEY_CUTS + 1) / n).cast("int") - 1))).otherwise(F.array().cast("array<bigint>"))
    plan = stats.select(*[F.col(k).alias(f"_p_{k}") for k in key], cuts.alias("_cuts"))
    cut = df.join(F.broadcast(plan), _same(df, plan, key, "_p_"))
    ranged = with_cuts_below(cut, "_range", lead, F.col("_cuts"), most).drop("_cuts", *[f"_p_{k}" for k in key])
    sizes = ranged.groupBy(*key, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*[F.col(k).alias(f"_o_{k}") for k in key], F.col("_range").alias("_o_range"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")).checkpoint()
    local = ranged.withColumn("_local", number)
    # null-safe, or the condition that the range isn't null would work it out twice
    return (local.join(F.broadcast(offsets), _same(local, offsets, key, "_o_") & local["_range"].eqNullSafe(offsets["_o_range"]))
            .withColumn(col, F.col("_before") + F.col("_local"))
            .drop("_range", "_local", "_before", "_o_range", *[f"_o_{k}" for k in key]))


def batch_within_key(df: DataFrame, key: list[str], order: list[str], batch_rows: int,
                     col: str = "batch") -> DataFrame:
    """Batch number ``rank div batch_rows`` plus the rank itself."""
    ranked = rank_within_key(df, key, order)
    return ranked.withColumn(col, F.call_function("div", F.col("rank"), F.lit(batch_rows)))
