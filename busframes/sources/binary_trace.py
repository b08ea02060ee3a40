"""Binary recording scan: files of back-to-back records -> frames.

Record layout (big-endian): seconds i32, nanoseconds i32, port type i8,
port id i8, payload length i16, then the payload: frame id i32, control word
i32 and ``length - 8`` data bytes. Records carry no sync mark.

Ways in, all producing the same rows:
- ``read_binary_trace``: files up to ``range_bytes`` are framed in bounded
  chunks (``frame_stream``), small ones packed into shared tasks; larger files
  by one task per range (``split_framing``);
- ``frame_records``: framing of binary columns (``binaryFile`` rows or
  in-memory recordings) in ``mapInArrow``.
When every record in a buffer has the same length (the usual case for
classic CAN) it is framed by strided numpy views; otherwise a header walk
finds the record starts.
"""

from __future__ import annotations

import struct
from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframes.sources.text_trace import ParsedTrace

HEADER_SIZE = 12
PAYLOAD_MIN = 8  # frame id + control word

FRAMED_SCHEMA = ("source string, position bigint, module smallint, ts bigint, id int, "
                 "cs int, data array<int>, reason string")

RAW_FRAME_COLUMNS = ("module", "ts", "id", "data")

RANGE_BYTES = 128 << 20   # larger recordings are framed by one task per range
BATCH_FRAMES = 20_000     # frames per Arrow batch
TASK_BYTES = 32 << 20     # of whole recordings that one task frames
OPEN_BYTES = 128 << 10    # what opening a recording costs, in bytes


def _decode_records(content, starts, lengths) -> dict:
    """Vectorised decode of complete records at ``starts`` (numpy columns)."""
    import numpy as np

    buf = np.frombuffer(content, dtype=np.uint8)
    m = len(starts)
    starts = np.asarray(starts, dtype=np.int64)
    lengths = np.asarray(lengths, dtype=np.int64)

    def be32(off):
        return (buf[starts + off].astype(np.int64) << 24 | buf[starts + off + 1].astype(np.int64) << 16
                | buf[starts + off + 2].astype(np.int64) << 8 | buf[starts + off + 3].astype(np.int64))

    def s32(x):
        return np.where(x >= 2**31, x - 2**32, x).astype(np.int64)

    high = s32(be32(0))
    low = s32(be32(4))
    port = buf[starts + 9].astype(np.int16)
    port = np.where(port >= 128, port - 256, port)
    low_us = np.where(low >= 0, low // 1000, -((-low) // 1000))
    data_len = lengths - PAYLOAD_MIN
    if np.all(data_len == data_len[0]):
        w = int(data_len[0])
        idx = (starts + HEADER_SIZE + PAYLOAD_MIN)[:, None] + np.arange(w)[None, :]
        values = buf[idx].astype(np.int32).ravel()
        offsets = np.arange(0, (m + 1) * w, w, dtype=np.int32) if w else np.zeros(m + 1, np.int32)
    else:
        offsets = np.concatenate([[0], np.cumsum(data_len)]).astype(np.int64)
        first = starts + HEADER_SIZE + PAYLOAD_MIN          # first data byte of each record
        idx = np.repeat(first - offsets[:-1], data_len) + np.arange(offsets[-1], dtype=np.int64)
        values = buf[idx].astype(np.int32)
        offsets = offsets.astype(np.int32)
    return {"position": starts, "ts": high * 1_000_000 + low_us, "module": (port + 1).astype(np.int16),
            "id": s32(be32(HEADER_SIZE)).astype(np.int32), "cs": s32(be32(HEADER_SIZE + 4)).astype(np.int32),
            "data": (offsets, values)}


def _frame_one(content, source: str):
    """Frame one whole file: (frame count, columns, reject or None, size)."""
    starts, lengths, reject, _ = _record_starts(content, final=True)
    m = len(starts)
    return m, (_decode_records(content, starts, lengths) if m else {}), reject, len(content)


def _record_starts(content, final: bool = True):
    """Offsets and payload lengths of the complete records of ``content``,
    a reject (position, reason) or None, and the bytes consumed.

    ``final=False`` frames a chunk of a longer stream: an incomplete record
    at the end is left unconsumed for the next chunk instead of rejected.
    """
    import numpy as np

    n = len(content)
    if n < HEADER_SIZE:
        return [], [], None, (n if final else 0)
    first_len = struct.unpack_from(">h", content, 10)[0]
    if first_len >= PAYLOAD_MIN:
        rec = HEADER_SIZE + first_len
        m = n // rec
        buf = np.frombuffer(content, dtype=np.uint8)
        starts = np.arange(m, dtype=np.int64) * rec
        lens = (buf[starts + 10].astype(np.int32) << 8) | buf[starts + 11]
        tail = n - m * rec
        if np.all(lens == first_len) and (tail < HEADER_SIZE or not final):
            return starts, np.full(m, first_len, dtype=np.int64), None, (n if final else m * rec)
    # general case: walk the headers; runs of equal-length records are
    # checked K headers at a time with numpy and jumped over
    buf = np.frombuffer(content, dtype=np.uint8)
    starts, lens = [], []
    pos = 0
    k = 16
    cooldown, backoff = 0, 16
    while n - pos >= HEADER_SIZE:
        length = struct.unpack_from(">h", content, pos + 10)[0]
        if length < PAYLOAD_MIN:
            return starts, lens, (pos, f"payload length {length} < {PAYLOAD_MIN}"), n
        stride = HEADER_SIZE + length
        if pos + stride > n:
            if final:
                return starts, lens, (pos, "truncated record"), n
            return starts, lens, None, pos
        span = min(k, (n - pos) // stride)     # records of this length that fit
        if cooldown:
            cooldown -= 1
        elif span >= 8:
            idx = pos + np.arange(span, dtype=np.int64) * stride
            run_lens = (buf[idx + 10].astype(np.int32) << 8) | buf[idx + 11]
            same = run_lens == length
            run = span if same.all() else int(np.argmin(same))
            if run >= 8:
                starts.extend(idx[:run].tolist())
                lens.extend([length] * run)
                pos += run * stride
                k = min(k * 4, 1 << 16) if run == span else max(16, run * 2)
                backoff = 16
                continue
            # short runs: step record by record, probing less often each time
            k, cooldown, backoff = 16, backoff, min(backoff * 2, 4096)
        starts.append(pos)
        lens.append(length)
        pos += stride
    return starts, lens, None, (n if final else pos)


def _arrow_schema():
    import pyarrow as pa

    return pa.schema([
        ("source", pa.string()), ("position", pa.int64()), ("module", pa.int16()),
        ("ts", pa.int64()), ("id", pa.int32()), ("cs", pa.int32()),
        ("data", pa.list_(pa.int32())), ("reason", pa.string()),
    ])


def _to_batches(source, m: int, cols: dict, reject, base: int = 0):
    """Arrow batches (FRAMED_SCHEMA) for framed records and a reject."""
    import pyarrow as pa

    schema = _arrow_schema()
    if m:
        offsets, values = cols["data"]
        yield pa.RecordBatch.from_arrays([
            pa.array([source] * m, pa.string()),
            pa.array(cols["position"] + base, pa.int64()),
            pa.array(cols["module"], pa.int16()),
            pa.array(cols["ts"], pa.int64()),
            pa.array(cols["id"], pa.int32()),
            pa.array(cols["cs"], pa.int32()),
            pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())),
            pa.nulls(m, pa.string()),
        ], schema=schema)
    if reject is not None:
        pos, reason = reject
        yield pa.RecordBatch.from_arrays([
            pa.array([source], pa.string()), pa.array([pos + base], pa.int64()),
            pa.nulls(1, pa.int16()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
            pa.nulls(1, pa.int32()), pa.nulls(1, pa.list_(pa.int32())),
            pa.array([reason], pa.string()),
        ], schema=schema)


def _frame_batches(batches: Iterator, content_col: str, source_col: str | None):
    for batch in batches:
        contents = batch.column(content_col)
        sources = batch.column(source_col) if source_col else None
        views = _binary_views(contents)
        for i in range(batch.num_rows):
            source = sources[i].as_py() if sources is not None else None
            m, cols, reject, _ = _frame_one(views[i], source)
            yield from _to_batches(source, m, cols, reject)


def _framed(source, content, starts, lengths, reject, base: int = 0, where=None):
    """Arrow batches of bounded size for records of ``content``; with
    ``where`` (a FrameFilter) other records are dropped by their headers,
    before anything is built for them."""
    import numpy as np

    starts, lengths = np.asarray(starts, np.int64), np.asarray(lengths, np.int64)
    if where is not None and not where.all and len(starts):
        on = where.mask(np.frombuffer(content, np.uint8), starts)
        starts, lengths = starts[on], lengths[on]
    for a in range(0, len(starts), BATCH_FRAMES):
        s, n = starts[a:a + BATCH_FRAMES], lengths[a:a + BATCH_FRAMES]
        yield from _to_batches(source, len(s), _decode_records(content, s, n), None, base)
    if reject is not None:
        yield from _to_batches(source, 0, {}, reject, base)


def frame_stream(read_chunk, source: str, chunk_bytes: int, where=None):
    """Frame one recording read sequentially in chunks of ``chunk_bytes``:
    memory stays bounded by the chunk size, whatever the file size.
    ``read_chunk(n)`` returns up to n bytes, ``b""`` at the end."""
    carry = b""
    base = 0
    while True:
        chunk = read_chunk(chunk_bytes)
        final = not chunk
        buf = carry + chunk if carry else chunk
        starts, lengths, reject, consumed = _record_starts(buf, final=final)
        yield from _framed(source, buf, starts, lengths, reject, base, where)
        if final or reject is not None:
            return
        carry = buf[consumed:]
        base += consumed


def _binary_views(arr) -> list:
    """Zero-copy views of the values of an Arrow binary array (a recording
    can be hundreds of MB; ``as_py`` would copy it)."""
    import numpy as np
    import pyarrow as pa

    if pa.types.is_large_binary(arr.type):
        width = np.int64
    else:
        width = np.int32
    _, offsets_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(offsets_buf, dtype=width)[arr.offset: arr.offset + len(arr) + 1]
    data = memoryview(data_buf) if data_buf is not None else memoryview(b"")
    return [b"" if not arr[i].is_valid else data[int(offsets[i]):int(offsets[i + 1])]
            for i in range(len(arr))]


def frame_records(files: DataFrame, content_col: str = "content",
                  source_col: str | None = "path") -> DataFrame:
    """Frame a DataFrame of whole recordings (one binary row per file).

    Output: FRAMED_SCHEMA; ``reason`` is null for frames, set for rejects.
    """
    from busframes.session import ship_package

    ship_package(files.sparkSession)
    cols = [content_col] + ([source_col] if source_col else [])
    return files.select(*cols).mapInArrow(
        lambda it: _frame_batches(it, content_col, source_col), FRAMED_SCHEMA)


def split_framed(framed: DataFrame) -> ParsedTrace:
    frames = framed.filter(F.col("reason").isNull()).select(*RAW_FRAME_COLUMNS, "cs")
    rejects = framed.filter(F.col("reason").isNotNull()).select("source", "position", "reason")
    return ParsedTrace(frames, rejects, framed)


def read_raw_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """The untouched recordings: path, length, content (the raw-trace fetch)."""
    reader = spark.read.format("binaryFile")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", "content")


def _tasks(spark: SparkSession, total_bytes: int) -> int:
    """Tasks for whole recordings: a task costs more to begin than a small
    recording to frame, so their number goes by bytes, not by files."""
    return max(4 * spark.sparkContext.defaultParallelism, -(-total_bytes // TASK_BYTES))


def read_binary_trace(spark: SparkSession, path: str, glob: str | None = None,
                      order_by_ts: bool = False, range_bytes: int = RANGE_BYTES,
                      ids: tuple[int, ...] | None = None, where=None) -> ParsedTrace:
    """Scan binary recordings (file, directory or glob; any Hadoop URI) into
    raw frames. Files are treated one by one: those up to ``range_bytes`` are
    framed whole, packed into shared tasks by their bytes; larger ones range by range. The
    rows don't depend on it. ``ids`` keeps frames with these ids only,
    ``where`` (a FrameFilter) frames of given ids, modules and times."""
    from busframes.sources.frame_filter import FrameFilter
    from busframes.sources.recording_source import frame_files, list_recordings
    from busframes.sources.split_framing import read_ranges

    where = where or FrameFilter()
    where = where if ids is None else where.and_ids(ids)
    files = list_recordings(spark, path, glob)
    whole = F.col("length") <= range_bytes
    large = files.filter(~whole)
    found = files.agg(F.coalesce(F.sum(F.when(whole, F.col("length") + OPEN_BYTES)), F.lit(0)).alias("small"),
                      F.count(F.when(~whole, F.lit(1))).alias("large")).first()
    framed = frame_files(files.filter(whole).coalesce(_tasks(spark, found["small"])), where=where)
    if found["large"]:
        framed = framed.unionByName(read_ranges(large, range_bytes, where))
    out = split_framed(framed)
    if order_by_ts:
        out = ParsedTrace(out.frames.orderBy("ts"), out.rejects, out.rows)
    return out
