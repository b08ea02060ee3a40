"""SQL access to decoded results: one wide view per message layout.

Decoded rows are stored once, partitioned by message, with positional values
(``vals``); the signal names live in the dictionary, not on every row. A
layout belongs to an identifier and a message name together: a name listed
under two identifiers gets a view for each. A wide view selects its message's
partition (pruned by the directory layout) and its id, and names the values.
"""

from __future__ import annotations

import re
from collections import Counter
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframes.operators.shape import wide_from_array
from busframes.sources.dictionary import SignalDictionary

Layout = tuple[int, str]


def read_message_table(spark: SparkSession, path: str, identifier: int, botschaft: str,
                       signal_names: list[str]) -> DataFrame:
    """One layout's wide table: ts, id, one column per signal."""
    rows = spark.read.parquet(path).filter((F.col("botschaft") == F.lit(botschaft)) & (F.col("id") == F.lit(identifier)))
    return wide_from_array(rows, signal_names, keep=("ts", "id"))


def view_names(layouts: list[tuple[int, str, list[str]]], prefix: str = "msg_") -> dict[Layout, str]:
    """A distinct name per layout: the message's name with other characters
    as ``_``; where that is taken twice (names that differ in such characters
    or case, or one name under several identifiers) the identifier follows,
    and where a name then still clashes, a running number."""
    plain = {(i, b): prefix + re.sub(r"[^0-9A-Za-z_]", "_", b) for i, b, _ in layouts}
    often = Counter(v.lower() for v in plain.values())
    out: dict[Layout, str] = {}
    used: set[str] = {v.lower() for v in plain.values() if often[v.lower()] == 1}
    for key in sorted(plain):
        name = plain[key]
        if often[name.lower()] > 1:
            base = name = f"{name}_{key[0]}"
            n = 2
            while name.lower() in used:
                name, n = f"{base}_{n}", n + 1
            used.add(name.lower())
        out[key] = name
    return out


def register_message_views(spark: SparkSession, path: str, dictionary: SignalDictionary,
                           prefix: str = "msg_") -> dict[Layout, str]:
    """Register a temp view per layout (lazy; no data is read here) and a
    long view ``<prefix>all`` over every stored row. Returns
    (identifier, message) -> view."""
    layouts = dictionary.layouts()
    views = view_names(layouts, prefix)
    for identifier, botschaft, names in layouts:
        read_message_table(spark, path, identifier, botschaft, names).createOrReplaceTempView(views[identifier, botschaft])
    spark.read.parquet(path).createOrReplaceTempView(prefix + "all")
    return views


def stored_layouts(spark: SparkSession, path: str) -> set[Layout]:
    """Layouts present in a message-partitioned table: a distinct over its
    message directories and ids (bounded by the dictionary)."""
    return {(r.id, str(r.botschaft)) for r in spark.read.parquet(path).select("id", "botschaft").distinct().collect()}


def export_message_tables(spark: SparkSession, path: str, dictionary: SignalDictionary,
                          write: Callable[[DataFrame, str], None],
                          table_for: Callable[[int, str], str] | None = None,
                          shape: Callable[[DataFrame], DataFrame] = lambda df: df) -> list[str]:
    """One target table per layout (named columns): each pruned wide table,
    after ``shape``, is handed to ``write(df, table)`` (e.g. Spark's JDBC
    writer). Each write reads only that message's directory; layouts with
    no stored rows are skipped. Default table names: those of the views."""
    layouts = dictionary.layouts()
    present = stored_layouts(spark, path)
    names = view_names(layouts, "")
    done = []
    for identifier, botschaft, signals in layouts:
        if (identifier, botschaft) not in present:
            continue
        table = table_for(identifier, botschaft) if table_for else names[identifier, botschaft]
        write(shape(read_message_table(spark, path, identifier, botschaft, signals)), table)
        done.append(table)
    return done
