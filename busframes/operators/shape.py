"""Reshaping decoded frames: replay, projections, long / map / wide forms,
key-value cells. All narrow (no shuffle) except where noted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400 * 1_000_000


def replay(frames: DataFrame, first_day: int = 199, last_day: int = 209,
           step: int = MICROS_PER_DAY, ts_col: str = "ts") -> DataFrame:
    """Repeat each frame once per day offset, shifting ``ts`` by day x step.

    A narrow ``explode``; predicates on other columns are pushed below it.
    """
    days = F.explode(F.sequence(F.lit(first_day), F.lit(last_day)))
    return (frames.withColumn("_day", days)
            .withColumn(ts_col, F.col(ts_col) + F.col("_day").cast("bigint") * F.lit(step))
            .drop("_day"))


def long_from_array(decoded: DataFrame, keep: tuple = ("ts", "id", "botschaft")) -> DataFrame:
    """Positional values + carried names -> one row per signal (pos, signal_name, value)."""
    return decoded.select(*keep, F.posexplode(F.arrays_zip(
        F.col("names").alias("signal_name"), F.col("vals").alias("value"))).alias("pos", "z")
    ).select(*keep, "pos", "z.signal_name", "z.value")


def long_from_map(decoded: DataFrame, keep: tuple = ("ts", "id", "botschaft")) -> DataFrame:
    return decoded.select(*keep, F.explode("map").alias("signal_name", "value"))


def values_in_order(map_col="map", names="names") -> F.Column:
    """Map values re-ordered to the dictionary's signal order."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    n = F.col(names) if isinstance(names, str) else names
    return F.transform(n, lambda x: m[x])


def wide_from_names(decoded: DataFrame, signal_names: list[str], keep: tuple = ("ts",)) -> DataFrame:
    """Positional values + carried names -> one column per signal name (null
    where the message has none): a lookup of the name's position, no map."""
    at = {n: F.array_position("names", n).cast("int") for n in signal_names}
    return decoded.select(*keep, *[F.when(at[n] > 0, F.get("vals", at[n] - 1)).alias(n) for n in signal_names])


def wide_from_map(decoded: DataFrame, signal_names: list[str],
                  keep: tuple = ("ts",)) -> DataFrame:
    """Map form -> one column per signal name (null where absent)."""
    return decoded.select(*keep, *[F.col("map")[n].alias(n) for n in signal_names])


def wide_from_array(decoded: DataFrame, signal_names: list[str],
                    keep: tuple = ("ts",)) -> DataFrame:
    """Positional array -> named columns, for one message's signal list."""
    return decoded.select(*keep, *[F.get("vals", i).alias(n) for i, n in enumerate(signal_names)])


def wide_to_cells(wide: DataFrame, row_key: str, family: str) -> DataFrame:
    """Wide row -> key-value cells (row_key, family, qualifier, value string).

    Every column except the row key becomes a cell; qualifiers in name order.
    """
    cols = sorted(c for c in wide.columns if c != row_key)
    return (wide.select(F.col(row_key).cast("string").alias("row_key"),
                        *[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot("row_key", cols, "qualifier", "value")
            .select("row_key", F.lit(family).alias("family"), "qualifier", "value"))


def map_to_cells(decoded: DataFrame, row_key: str, family: str, map_col: str = "map") -> DataFrame:
    """Map row -> key-value cells, value as text."""
    return decoded.select(F.col(row_key).cast("string").alias("row_key"),
                          F.explode(map_col).alias("qualifier", "v")).select(
        "row_key", F.lit(family).alias("family"), "qualifier", F.col("v").cast("string").alias("value"))


def long_to_cells(long: DataFrame, row_key: str, family: str) -> DataFrame:
    """Long rows -> key-value cells, value as text."""
    return long.select(F.col(row_key).cast("string").alias("row_key"), F.lit(family).alias("family"),
                       F.col("signal_name").alias("qualifier"), F.col("value").cast("string").alias("value"))


def sorted_cells(cells: DataFrame) -> DataFrame:
    """Cells range-partitioned and sorted by (row_key, qualifier): each output
    partition is one contiguous, ordered key range (bulk-load order)."""
    return (cells.repartitionByRange("row_key", "qualifier")
            .sortWithinPartitions("row_key", "qualifier"))


def strings_map(df: DataFrame, columns: list[str] | None = None) -> F.Column:
    """Row -> map column name -> value as text; nulls stay null."""
    cols = columns or df.columns
    return F.map_from_arrays(F.array(*[F.lit(c) for c in cols]),
                             F.array(*[F.col(c).cast("string") for c in cols]))
