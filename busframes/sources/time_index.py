"""Time index of raw recordings: a small table beside them, one row per chunk
of back-to-back records: where it begins and ends, how many frames it holds,
their first and last time, and a bitmap of their ids.

Recordings carry no index of their own, so a lookup by time or id reads all
of them. With the table, Spark finds the chunks that can hold an answer (its
time bounds are pushed into the index's Parquet scan) and only these bytes are
opened; every chunk begins at a record, so it is framed without its file's
beginning. Building reads everything once: small files by one task each,
large ones by one task per range (``split_framing``).
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframes.sources.binary_trace import FRAMED_SCHEMA, RANGE_BYTES, ParsedTrace, _framed, _record_starts, split_framed
from busframes.sources.frame_filter import ID_BITS, FrameFilter, id_bit
from busframes.sources.recording_source import DEFAULT_CHUNK, MIN_CHUNK, list_recordings, open_file

INDEX_SCHEMA = ("path string, entry bigint, stop bigint, n bigint, min_ts bigint, max_ts bigint, ids array<bigint>, "
                "reject_at bigint, reason string")


def _headers(buf, starts):
    """(ts, ids) of records, from their headers alone."""
    import numpy as np

    def signed(at):
        x = sum(buf[starts + at + k].astype(np.int64) << (24 - 8 * k) for k in range(4))
        return np.where(x >= 2**31, x - 2**32, x)

    low = signed(4)
    return signed(0) * 1_000_000 + np.where(low >= 0, low // 1000, -((-low) // 1000)), signed(12)


def index_rows(read_at, path: str, entry: int, end: int, size: int, chunk: int) -> Iterator[dict]:
    """Index rows of the records that begin in [entry, end); a record begins
    at ``entry``. ``read_at(n, at)`` returns n bytes of the file."""
    import numpy as np

    from busframes.sources.split_framing import OVERLAP

    pos = entry
    while pos < min(end, size):
        buf = read_at(min(pos + chunk + OVERLAP, size) - pos, pos)
        eof = pos + len(buf) >= size
        starts, _, reject, consumed = _record_starts(buf, final=eof)
        starts = np.asarray(starts, np.int64)
        bound = min(chunk, end - pos)
        n = int(np.searchsorted(starts, bound))
        if reject is not None and reject[0] >= bound:
            consumed, reject, eof = reject[0], None, False
        stop = pos + (int(starts[n]) if n < len(starts) else consumed)
        row = dict(path=path, entry=pos, stop=stop, n=n, min_ts=None, max_ts=None, ids=None, reject_at=None, reason=None)
        if n:
            ts, ids = _headers(np.frombuffer(buf, np.uint8), starts[:n])
            words = [0] * (ID_BITS // 64)
            for x in np.unique(ids).tolist():
                words[id_bit(x) >> 6] |= 1 << (id_bit(x) & 63)
            row |= dict(min_ts=int(ts.min()), max_ts=int(ts.max()), ids=[w - 2**64 if w >= 2**63 else w for w in words])
        if reject is not None:
            row |= dict(stop=pos + reject[0], reject_at=pos + reject[0], reason=reject[1])
        if n or reject is not None:
            yield row
        if reject is not None or (n == len(starts) and eof):
            return
        pos = stop


def build_time_index(spark: SparkSession, path: str, glob: str | None = None, chunk_bytes: int = DEFAULT_CHUNK,
                     range_bytes: int = RANGE_BYTES) -> DataFrame:
    """INDEX_SCHEMA rows of all recordings under ``path``; write them as
    Parquet beside the recordings."""
    from busframes.session import ship_package
    from busframes.sources.split_framing import range_entries

    ship_package(spark)
    chunk = max(chunk_bytes, MIN_CHUNK)

    def run(batches) -> Iterator:
        import pyarrow as pa

        kind = pa.schema([("path", pa.string()), ("entry", pa.int64()), ("stop", pa.int64()), ("n", pa.int64()), ("min_ts", pa.int64()),
                          ("max_ts", pa.int64()), ("ids", pa.list_(pa.int64())), ("reject_at", pa.int64()), ("reason", pa.string())])
        for batch in batches:
            for r in batch.to_pylist():
                with open_file(r["path"]) as f:
                    rows = list(index_rows(f.read_at, r["path"], r["entry"], r["end"], r["size"], chunk))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    files = list_recordings(spark, path, glob)
    small = files.filter(F.col("length") <= range_bytes).select(
        "path", F.col("length").alias("size"), F.lit(0).cast("bigint").alias("entry"), F.col("length").alias("end"))
    out = small.mapInArrow(run, INDEX_SCHEMA)
    large = files.filter(F.col("length") > range_bytes)
    if large.limit(1).count():
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        entries = range_entries(large, range_bytes).select("path", "size", "entry", "end").repartition(parts, "path", "entry")
        out = out.unionByName(entries.mapInArrow(run, INDEX_SCHEMA))
    return out


def chunks_for(index: DataFrame, where: FrameFilter) -> DataFrame:
    """The index rows of chunks that can hold a frame of ``where``."""
    if where.ts_from is not None:
        index = index.filter(F.col("max_ts") >= F.lit(where.ts_from))
    if where.ts_to is not None:
        index = index.filter(F.col("min_ts") <= F.lit(where.ts_to))
    if where.ids is not None:
        bits = [F.get("ids", id_bit(x) >> 6).bitwiseAND(F.lit(1).cast("bigint") if not id_bit(x) & 63 else F.shiftleft(F.lit(1).cast("bigint"), id_bit(x) & 63)) != 0
                for x in where.ids]
        some = F.lit(False)
        for b in bits:
            some |= b
        index = index.filter(some)
    return index


def frame_range(path: str, entry: int, stop: int, where: FrameFilter, reject=None) -> Iterator:
    """Framed rows of one chunk; only its bytes are read."""
    with open_file(path) as f:
        buf = f.read_at(stop - entry, entry)
    starts, lengths, _, _ = _record_starts(buf, final=True)
    yield from _framed(path, buf, starts, lengths, None, entry, where)
    if reject is not None and reject[0] is not None:
        yield from _framed(path, b"", [], [], reject, 0, where)


def read_indexed(index: DataFrame, where: FrameFilter | None = None) -> ParsedTrace:
    """Frames of ``where`` from the chunks that can hold them."""
    from busframes.session import ship_package

    spark = index.sparkSession
    ship_package(spark)
    where = where or FrameFilter()

    def run(batches) -> Iterator:
        for batch in batches:
            for r in batch.to_pylist():
                yield from frame_range(r["path"], r["entry"], r["stop"], where, (r["reject_at"], r["reason"]))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks_for(index, where).select("path", "entry", "stop", "reject_at", "reason")
    return split_framed(chunks.repartition(parts, "path", "entry").mapInArrow(run, FRAMED_SCHEMA))
