"""The signal dictionary: one row per (message id, message name, signal).

Read from a database table (JDBC) or, offline, from parquet/CSV with the same
five columns, then aggregated to one row per message with its signal layout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DICTIONARY_COLUMNS = ("identifier", "botschaft", "signal_name", "startBit", "len")

# A broadcast copy of the dictionary has at most this many bytes, by its
# measured names and layouts. Larger dictionaries take the salted shuffle join.
MAX_BROADCAST_BYTES = 32 << 20


def read_dictionary(spark: SparkSession, source: str, fmt: str = "jdbc",
                    options: dict | None = None) -> DataFrame:
    """Scan the raw dictionary and keep the five used columns, typed.

    ``fmt="jdbc"``: ``source`` is the table name; ``options`` carries url,
    driver, user, password (from the caller's configuration, never defaults).
    Otherwise ``source`` is a path read with that format (parquet, csv, ...).
    The identifier is stored as text in some databases: cast to int here so
    that predicates on ``id`` reach both sides of the join.
    """
    options = dict(options or {})
    if fmt == "jdbc":
        df = spark.read.format("jdbc").options(**options).option("dbtable", source).load()
    else:
        reader = spark.read.format(fmt).options(**options)
        if fmt == "csv":
            reader = reader.option("header", "true")
        df = reader.load(source)
    return df.select(
        F.col("identifier").cast("int").alias("identifier"),
        F.col("botschaft").cast("string").alias("botschaft"),
        F.col("signal_name").cast("string").alias("signal_name"),
        F.col("startBit").cast("int").alias("startBit"),
        F.col("len").cast("int").alias("len"),
    )


def aggregate_dictionary(rows: DataFrame) -> DataFrame:
    """One row per (identifier, botschaft) with ``info`` sorted by start bit.

    ``info: array<struct<startBit int, signal_name string, len int>>``. The
    sort fixes the positional order that array-form outputs rely on.
    """
    return (rows.groupBy("identifier", "botschaft")
            .agg(F.array_sort(F.collect_list(F.struct("startBit", "signal_name", "len")))
                 .alias("info")))


def unique_names(info) -> F.Column:
    """Drop signals whose name appears again later in ``info`` (last wins)."""
    info = F.col(info) if isinstance(info, str) else info
    return F.filter(info, lambda s, i: ~F.array_contains(
        F.slice(info["signal_name"], i + 2, F.greatest(F.size(info), F.lit(1))),
        s["signal_name"]))


@dataclass
class SignalDictionary:
    """Aggregated dictionary plus its size, measured once (persist + count).

    ``messages``: identifier, botschaft, info. ``n_bytes`` and
    ``n_signal_bytes``, the sizes of a broadcast copy of the messages and of
    one row per signal, decide the join strategy; ``most_signals`` (of one
    message) decides how layouts are decoded.
    """

    messages: DataFrame
    n_messages: int
    n_signals: int
    n_bytes: int
    n_signal_bytes: int
    most_signals: int = 0  # 0: not measured

    @classmethod
    def load(cls, rows: DataFrame, persist: bool = True) -> "SignalDictionary":
        messages = aggregate_dictionary(rows)
        if persist:
            messages = messages.persist(StorageLevel.MEMORY_AND_DISK)
        # a row: fixed fields, its name, and per signal two numbers, a name and their slots
        names = F.aggregate("info", F.lit(0).cast("bigint"), lambda a, s: a + F.octet_length(s["signal_name"]))
        row_bytes = F.lit(64) + F.octet_length("botschaft") + F.size("info") * F.lit(56) + names
        stats = messages.agg(F.count(F.lit(1)).alias("m"),
                             F.coalesce(F.sum(F.size("info")), F.lit(0)).alias("s"),
                             F.coalesce(F.sum(row_bytes), F.lit(0)).alias("b"),
                             F.coalesce(F.sum(names + F.size("info") * (F.lit(96) + F.octet_length("botschaft"))), F.lit(0)).alias("r"),
                             F.coalesce(F.max(F.size("info")), F.lit(0)).alias("k")).first()
        return cls(messages, int(stats["m"]), int(stats["s"]), int(stats["b"]), int(stats["r"]), int(stats["k"]))

    @property
    def broadcastable(self) -> bool:
        return self.n_bytes <= MAX_BROADCAST_BYTES

    @property
    def signals_broadcastable(self) -> bool:
        return self.n_signal_bytes <= MAX_BROADCAST_BYTES

    def with_unique_names(self) -> DataFrame:
        return self.messages.withColumn("info", unique_names("info"))

    def signal_rows(self, unique: bool = False) -> DataFrame:
        """The layouts taken apart: identifier, botschaft, pos, signal_name,
        start and len, one row per signal. ``unique``: of signals with one
        name in a message the later one only."""
        messages = self.with_unique_names() if unique else self.messages
        return (messages.select("identifier", "botschaft", F.posexplode("info").alias("pos", "sig"))
                .select("identifier", "botschaft", "pos", "sig.signal_name", F.col("sig.startBit").alias("start"), "sig.len"))

    def ordered(self) -> DataFrame:
        """The messages by identifier, then name (byte order), their signals
        by start bit."""
        return self.messages.orderBy("identifier", "botschaft")

    def message_by_identifier(self) -> DataFrame:
        """One message name per identifier (the smallest, deterministic)."""
        return (self.messages.groupBy("identifier")
                .agg(F.min("botschaft").alias("botschaft")))

    def layouts(self) -> list[tuple[int, str, list[str]]]:
        """(identifier, message, ordered signal names) of every message; a
        name can stand under several identifiers with different layouts. One
        row per message of the dictionary comes to the driver."""
        rows = self.messages.select("identifier", "botschaft", F.col("info")["signal_name"].alias("names")).collect()
        return sorted((r.identifier, r.botschaft, list(r.names)) for r in rows)

    def unpersist(self) -> None:
        self.messages.unpersist()
