"""Test inputs derived from the driver tables (see FIXTURES.md).

Frames are *encoded* from ``lineitem`` columns; the DuckDB oracles read the
plain columns, so encoder and decoder are checked against arithmetic that
shares no code with them. All encoders are Spark jobs over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F



LINEITEM_COLUMNS = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")


def lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lineitem columns the encoders use, spread over the cluster when
    the file has fewer splits than cores (the driver tables are a single
    parquet row group)."""
    from busframes.operators.partition import ensure_parallelism

    return ensure_parallelism(spark.read.parquet(f"{sf_dir}/lineitem.parquet")
                              .select(*LINEITEM_COLUMNS))


FRAMES_PER_FILE_KEYS = 1000  # order keys per recording file


def raw_frames(li: DataFrame, with_file_key: bool = False) -> DataFrame:
    """lineitem -> raw frames (module smallint, ts bigint µs, id int, data array<int>).

    ``with_file_key`` adds ``file_key`` = l_orderkey div 1000: the recording
    a frame is written to. Files then hold the frames of 1,000 orders (at
    most ~7,000 frames) at every scale; their number grows with the table.
    """
    ok, pk, sk = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    b = lambda c: c.bitwiseAND(F.lit(255)).cast("int")
    hi = lambda c: F.shiftright(c, 8).bitwiseAND(F.lit(255)).cast("int")
    return li.select(
        (F.lit(1) + sk % 2).cast("smallint").alias("module"),
        ((ok % 100000) * 1000000 + F.col("l_linenumber") * 1000).cast("bigint").alias("ts"),
        (F.lit(100) + F.col("l_linenumber")).cast("int").alias("id"),
        F.array(b(ok), hi(ok), b(pk), hi(pk), b(sk), hi(sk),
                b(F.col("l_quantity").cast("bigint")), F.col("l_linenumber").cast("int")).alias("data"),
        *([F.call_function("div", ok, F.lit(FRAMES_PER_FILE_KEYS)).alias("file_key")] if with_file_key else []),
    )


# Fixed fixture dictionary: (identifier, message, signal, start bit, length).
FIXTURE_SIGNALS = [
    ("orderkey", 0, 16),
    ("partkey", 16, 16),
    ("mid", 20, 20),
    ("qty", 48, 8),
    ("flag", 31, 1),
]
FIXTURE_IDS = (101, 102, 103, 104, 105)
ALT_MESSAGE = (101, "MSG_ALT", [("orderkey", 0, 16)])


def dictionary_rows(spark: SparkSession) -> DataFrame:
    rows = [(i, f"MSG_{i}", n, s, l) for i in FIXTURE_IDS for n, s, l in FIXTURE_SIGNALS]
    rows += [(ALT_MESSAGE[0], ALT_MESSAGE[1], n, s, l) for n, s, l in ALT_MESSAGE[2]]
    return spark.createDataFrame(
        rows, "identifier int, botschaft string, signal_name string, startBit int, len int")


def two_layout_rows(spark: SparkSession) -> DataFrame:
    """``dictionary_rows`` and MSG_ALT once more, under id 106, with other
    signals than under id 101."""
    more = [(106, "MSG_ALT", "qty", 48, 8), (106, "MSG_ALT", "partkey", 16, 16)]
    return dictionary_rows(spark).unionByName(spark.createDataFrame(
        more, "identifier int, botschaft string, signal_name string, startBit int, len int"))


def fd_dictionary_rows(spark: SparkSession) -> DataFrame:
    """Signals behind and across the eighth byte, for every fixture id."""
    rows = [(i, "FD", n, s, l) for i in range(101, 108) for n, s, l in (("late", 80, 16), ("cross", 56, 16))]
    return spark.createDataFrame(rows, "identifier int, botschaft string, signal_name string, startBit int, len int")


def _line(li_ts, module, hex_id, count, payload) -> F.Column:
    return F.concat(F.lit("   "), li_ts, F.lit(" "), module, F.lit("  "), hex_id, F.lit("       Rx   d "), count, F.lit(" "), payload)


def fd_lines(li: DataFrame) -> DataFrame:
    """One log line per row of lineitem with a payload of 12 to 64 bytes: its
    8 fixture bytes over and over; lower case for odd order keys."""
    fr = raw_frames(li, with_file_key=False).withColumn("n", F.element_at(F.array(*map(F.lit, FD_SIZES)), F.col("id") - 100))
    text = F.concat_ws(" ", F.repeat(F.concat(_hex8("data"), F.lit(" ")), 8))
    text = F.substring(text, F.lit(1), 3 * F.col("n") - 1)
    text = F.when(F.get("data", 0) % 2 == 1, F.lower(text)).otherwise(text)
    return fr.select(_line(_seconds6("ts"), F.lit("1"), F.lower(F.hex("id")), F.col("n").cast("string"), text).alias("value"))


#: payload bytes of FD lines by line number
FD_SIZES = (12, 16, 20, 24, 32, 48, 64)


def damaged_lines(li: DataFrame) -> DataFrame:
    """One log line per row of lineitem, damaged by its line number: 1 a byte
    missing, 2 a byte too many, 3 no hex byte, 4 a bad id, 5 a mixed-case
    frame with text behind its payload, 6 bad seconds, 7 no ``d``."""
    fr = raw_frames(li)
    at = lambda n: F.col("id") == 100 + n
    full = _hex8("data")
    payload = (F.when(at(1), F.substring(full, 1, 20)).when(at(2), F.concat(full, F.lit(" 0a"))).when(at(3), F.concat(F.substring(full, 1, 21), F.lit("g1")))
               .when(at(5), F.concat(F.lower(F.substring(full, 1, 9)), F.substring(full, 10, 14), F.lit("  Length = 240000 BitCount = 124"))).otherwise(full))
    line = _line(F.when(at(6), "1.2.3").otherwise(_seconds6("ts")), F.lit("1"), F.when(at(4), "XYZ").otherwise(F.hex("id")), F.lit("8"), payload)
    return fr.select(F.when(at(7), F.regexp_replace(line, " d 8 ", " 8 ")).otherwise(line).alias("value"))


def text_lines(frames: DataFrame) -> DataFrame:
    """Raw frames -> text log lines (value string). Module 2 ids carry the
    29-bit ``x`` suffix. Relative seconds keep the leading blanks."""
    hex_id = F.concat(F.upper(F.hex("id")), F.when(F.col("module") == 2, F.lit("x")).otherwise(F.lit("")))
    return frames.select(F.concat(
        F.lit("   "), _seconds6("ts"), F.lit(" "),
        F.col("module").cast("string"), F.lit("  "), hex_id,
        F.lit("       Rx   d "), F.size("data").cast("string"), F.lit(" "),
        _hex8("data")).alias("value"))


def _hex8(data: str) -> F.Column:
    """Fixture payloads are always 8 bytes: fixed two-digit hex per byte."""
    return F.concat_ws(" ", *[F.lpad(F.hex(F.get(data, k)), 2, "0") for k in range(8)])


def _seconds6(ts_us: str) -> F.Column:
    """µs -> seconds text with 6 decimals (exact; same text as ``%.6f``)."""
    ts = F.col(ts_us)
    return F.concat(F.call_function("div", ts, F.lit(1000000)).cast("string"), F.lit("."),
                    F.lpad((ts % 1000000).cast("string"), 6, "0"))


# Fixed header lines of a text log (not frames: no leading blank), plus one
# event line that passes the prefix filter but is not a frame.
TEXT_HEADER = ["date Thu Dec 3 06:00:00.000 am 2026", "base hex  timestamps absolute",
               "internal events logged"]
TEXT_EVENT = "   0.000000 Start of measurement"


def text_trace_lines(spark: SparkSession, frames: DataFrame) -> DataFrame:
    extra = spark.createDataFrame([(v,) for v in TEXT_HEADER + [TEXT_EVENT]], "value string")
    return extra.unionByName(text_lines(frames))


def _low_bytes(values, n: int):
    """The low ``n`` bytes of each whole number, big-endian, as a matrix."""
    import numpy as np

    return np.ascontiguousarray(values, ">i8").view(np.uint8).reshape(-1, 8)[:, 8 - n:]


def _two_digits(values):
    """The first two hex digits of each number (negative: of its 64 bits)."""
    import numpy as np

    x = np.asarray(values, np.int64).view(np.uint64)
    while (large := x > 255).any():
        x = np.where(large, x >> np.uint64(4), x)
    return x.astype(np.uint8)


def _records(rows) -> bytes:
    """The records of one file (an Arrow table of frames) in (ts, id) order,
    ties by their bytes. Frames without ts, module, id or data give none; a
    null byte of the data is left out."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    rows = rows.select(["ts", "id", "module", "data"]).drop_null().combine_chunks()
    n = rows.num_rows
    if not n:
        return b""
    ts, fid, module = (rows.column(c).to_numpy().astype(np.int64) for c in ("ts", "id", "module"))
    data = rows.column("data").combine_chunks()
    data = data.chunk(0) if isinstance(data, pa.ChunkedArray) else data
    size = pc.list_value_length(data).to_numpy(zero_copy_only=False).astype(np.int64)
    values = data.flatten()
    there = values.is_valid().to_numpy(zero_copy_only=False)
    held = np.add.reduceat(np.append(there, False), np.cumsum(size) - size, dtype=np.int64) * (size > 0)
    payload = _two_digits(values.drop_null().to_numpy(zero_copy_only=False))
    zero = np.zeros(n, np.int64)
    head = np.hstack([_low_bytes(np.floor(ts / 1000000), 4), _low_bytes(np.fmod(ts, 1000000) * 1000, 4), _low_bytes(zero + 1, 1), _low_bytes(module - 1, 1),
                      _low_bytes(size + 8, 2), _low_bytes(fid, 4), _low_bytes(zero, 1), _low_bytes(size, 1), _low_bytes(zero, 2)])
    if (held == held[0]).all():
        recs = np.ascontiguousarray(np.hstack([head, payload.reshape(n, int(held[0]))]))
        order = np.lexsort((fid, ts))
        if ((np.diff(ts[order]) == 0) & (np.diff(fid[order]) == 0)).any():
            order = np.lexsort((recs.view(f"S{recs.shape[1]}").ravel(), fid, ts))
        return recs[order].tobytes()
    ends = np.cumsum(held)
    recs = [head[i].tobytes() + payload[ends[i] - held[i]:ends[i]].tobytes() for i in range(n)]
    return b"".join(recs[i] for i in sorted(range(n), key=lambda i: (ts[i], fid[i], recs[i])))


def binary_blobs(frames: DataFrame) -> DataFrame:
    """(file_key, content binary): records of a file in (ts, id) order.
    A group is one file (bounded by ``FRAMES_PER_FILE_KEYS`` orders), encoded
    as whole columns."""
    from busframes.session import ship_package

    ship_package(frames.sparkSession)

    def encode(key, rows):
        import pyarrow as pa

        return pa.table({"file_key": pa.array([key[0].as_py()], pa.int64()), "content": pa.array([_records(rows)], pa.binary())})

    return frames.select("file_key", "ts", "id", "module", "data").groupBy("file_key").applyInArrow(encode, "file_key bigint, content binary")


def write_blobs(blobs: DataFrame, out_dir: str) -> None:
    """Write each blob to ``out_dir/part-<key>.bin`` from the executors.

    Spark has no raw-binary writer; each task opens the target through
    pyarrow's file-system layer, which resolves local, HDFS and object-store
    URIs alike.
    """
    def write_part(batches):
        import pyarrow as pa
        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(out_dir)
        filesystem.create_dir(root, recursive=True)
        n = 0
        for batch in batches:
            keys = batch.column("file_key").to_pylist()
            contents = batch.column("content")
            for i, key in enumerate(keys):
                with filesystem.open_output_stream(f"{root}/part-{key:06d}.bin") as f:
                    f.write(contents[i].as_py())
                n += 1
        yield pa.RecordBatch.from_pydict({"n": [n]})

    from busframes.session import ship_package

    ship_package(blobs.sparkSession)
    blobs.select("file_key", "content").mapInArrow(write_part, "n bigint").agg(F.sum("n")).collect()
