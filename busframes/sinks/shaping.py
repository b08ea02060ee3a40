"""Rows -> what a target store takes: multi-row INSERT text, time-series
points / line protocol, wide-store rows, key-value cells.

Batches hold ``batch_rows`` consecutive rows (by ts) of one target table; the
numbering is skew-safe (``operators.batching``) and every batch is assembled
by a group-by whose groups are bounded by ``batch_rows``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.functions.bits import WRITTEN_OUT
from busframes.functions.timefmt import micros_to_millis_timestamp
from busframes.operators.batching import batch_within_key

TWO_POW_64 = 18446744073709551616


def row_tuple(ts="ts", vals="vals") -> F.Column:
    """``(ts,v1,v2,...)``; a null value is written as NULL."""
    return F.concat(F.lit("("), F.col(ts).cast("string"), F.lit(","),
                    F.array_join(F.col(vals).cast("array<string>"), ",", "NULL"),
                    F.lit(")"))


def insert_statements(decoded: DataFrame, batch_rows: int = 5000, prefix: str = "Datalogger1_",
                      suffix: str = "", device: str = "Datalogger1", tag_number: int = 2,
                      with_tags: bool = True) -> DataFrame:
    """Array-form rows -> one multi-row INSERT per (message, batch).

    ``INSERT INTO <prefix><msg><suffix> USING <msg> TAGS (<n>,"<device>")
    VALUES (ts,v1,...) (ts,v1,...)``; rows in ts order inside a statement.
    Output: botschaft, batch, n_rows, statement.
    """
    rows = decoded.select("botschaft", "ts", "id", row_tuple().alias("row_text"))
    batched = batch_within_key(rows, ["botschaft"], ["ts", "id", "row_text"], batch_rows)
    grouped = (batched.groupBy("botschaft", "batch")
               .agg(F.count(F.lit(1)).alias("n_rows"),
                    F.array_sort(F.collect_list(F.struct("rank", "row_text"))).alias("_rows")))
    head = F.concat(F.lit("INSERT INTO "), F.lit(prefix), F.col("botschaft"), F.lit(suffix))
    if with_tags:
        head = F.concat(head, F.lit(" USING "), F.col("botschaft"),
                        F.lit(f' TAGS ({tag_number},"{device}")'))
    return grouped.select(
        "botschaft", "batch", "n_rows",
        F.concat(head, F.lit(" VALUES "), F.array_join(F.col("_rows")["row_text"], " ")).alias("statement"))


def _escape_key(c: F.Column) -> F.Column:
    for mark in (",", "=", " "):
        c = F.replace(c, F.lit(mark), F.lit("\\" + mark))
    return c


def _has_field() -> F.Column:
    """A point needs a field; frames too short for every signal have none."""
    return F.array_max("vals").isNotNull()


def _with_fields(decoded: DataFrame) -> DataFrame:
    """Points only, their fields (name and value) sorted by name."""
    return decoded.filter(_has_field()).withColumn(
        "_fields", F.sort_array(F.arrays_zip(F.col("names").alias("k"), F.col("vals").alias("v"))))


def _point_head(device: str, most: int = 0) -> F.Column:
    """``<measurement>,device=<device> f1=1i,f2=2i``: fields sorted by name,
    null fields left out, integers with the ``i`` suffix. ``most``: fields of
    a point at most (0: any number); few of them are written out."""
    def text(x):  # null without a value
        return F.concat(_escape_key(x["k"]), F.lit("="), x["v"].cast("string"), F.lit("i"))

    if 0 < most <= WRITTEN_OUT:
        field_text = F.concat_ws(",", *[text(F.get("_fields", k)) for k in range(most)])
    else:
        field_text = F.array_join(F.transform("_fields", text), ",")
    return F.concat(_escape_key(F.col("botschaft")), F.lit(",device="), _escape_key(F.lit(device)),
                    F.lit(" "), field_text)


def line_protocol(decoded: DataFrame, device: str = "Datalogger1", most: int = 0) -> DataFrame:
    """Array form with names -> one line-protocol record per frame, time in
    µs. Frames without any value give no point. ``most``: signals of a message
    at most, where known. Output: measurement, time, line."""
    return _with_fields(decoded).select(
        F.col("botschaft").alias("measurement"), F.col("ts").alias("time"),
        F.concat(_point_head(device, most), F.lit(" "), F.col("ts").cast("string")).alias("line"))


def hour_stamped_points(decoded: DataFrame, stamp=None, device: str = "Datalogger1") -> DataFrame:
    """Single points whose time is an explicit hour stamp ``yyyyMMddHH``
    (UTC), in ms; without a stamp the time is left to the store (null).
    Output: measurement, time_ms, line (line protocol, ms precision)."""
    from busframes.functions.timefmt import hour_stamp_to_millis

    time_ms = hour_stamp_to_millis(stamp) if stamp is not None else F.lit(None).cast("bigint")
    pts = _with_fields(decoded).withColumn("_t", time_ms)
    head = _point_head(device)
    return pts.select(F.col("botschaft").alias("measurement"), F.col("_t").alias("time_ms"),
                      F.when(F.col("_t").isNull(), head)
                      .otherwise(F.concat(head, F.lit(" "), F.col("_t").cast("string"))).alias("line"))


def unsigned_decimal(v) -> F.Column:
    """bigint holding an unsigned 64-bit value -> decimal(20,0)."""
    v = F.col(v) if isinstance(v, str) else v
    d = v.cast("decimal(20,0)")
    return F.when(v < 0, (d + F.lit(str(TWO_POW_64)).cast("decimal(20,0)")).cast("decimal(20,0)")).otherwise(d)


def wide_store_rows(decoded: DataFrame, device: str = "Datalogger1") -> DataFrame:
    """Array form with names -> wide-store rows: table, deviceid, ts
    (µs -> ms timestamp), names, values as unsigned decimal(20,0)."""
    return decoded.select(
        F.col("botschaft").alias("table_name"), F.lit(device).alias("deviceid"),
        micros_to_millis_timestamp("ts").alias("ts"), "names",
        F.transform("vals", unsigned_decimal).alias("vals"))


def region_of(row_key: str | F.Column, borders: list[str]) -> F.Column:
    """Region of a row key: how many of the sorted ``borders`` (each the first
    key of a region) are at most the key, in byte order."""
    from busframes.operators.ranges import cuts_below

    key = F.col(row_key) if isinstance(row_key, str) else row_key
    if not borders:
        return F.lit(0)
    return cuts_below(key, F.array(*[F.lit(b) for b in sorted(borders)]), len(borders))


def write_region_cells(cells: DataFrame, borders: list[str], path: str, fmt: str = "parquet") -> None:
    """Cells dealt by given region borders (those of the target table): one
    folder ``region=<number>`` each, its files sorted by (row key, qualifier).
    No file holds cells of two regions; a large region is written by several
    tasks. The input runs once."""
    from busframes.operators.partition import write_partitioned

    write_partitioned(cells.withColumn("region", region_of("row_key", borders)), path, ["region"], fmt=fmt, within=["row_key", "qualifier"])


def write_sorted_cells(cells: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Bulk-load layout for key-value cells: files that are contiguous,
    sorted (row key, qualifier) ranges.

    The range partitioner samples its input before shuffling it, so the cells
    are first written, unsorted, to the shared checkpoint folder: the upstream
    decode runs once, the sample reads the two key columns back, and no
    executor caches the output.
    """
    from busframes.operators.shape import sorted_cells
    from busframes.session import shared_dir

    spark = cells.sparkSession
    staged = shared_dir(spark, "unsorted-cells")
    cells.write.parquet(staged)
    sorted_cells(spark.read.parquet(staged)).write.mode("overwrite").format(fmt).save(path)
