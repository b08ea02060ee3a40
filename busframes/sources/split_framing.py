"""Exact parallel framing of large recordings.

Records carry no sync mark, so where a byte range's first record begins is
only known from the range before it. Two passes over the ranges of a file:

1. each range works out, for every offset at which a record can enter it (a
   record is at most MAX_RECORD bytes, so the entries lie in the first
   MAX_RECORD bytes), where the chain of records that begins there leaves it.
   Jumps of a record are doubled through twice that span; chains that meet are
   one from there on, and the few that are left are followed to the end;
2. maps compose: BLOCK neighbours become one map of a block, blocks of blocks
   again, until a file has few; from entry 0 at the top, entries go back down,
   block by block, which gives every range its one true entry. No task reads
   more than BLOCK maps of a file at a time, whatever its size;
3. each range is framed once from that entry.

There is no guess and nothing is framed again; the rows equal a sequential
walk. Ranges are rows of a table, never a list on the driver.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.sources.binary_trace import FRAMED_SCHEMA, HEADER_SIZE, PAYLOAD_MIN, _framed, _record_starts

MAX_RECORD = HEADER_SIZE + 32767        # a 16-bit payload length
OVERLAP = MAX_RECORD + HEADER_SIZE      # bytes read past a range's end
BLOCK = 32                              # maps that one task composes


def _follow(buf, base: int, pos: int, end: int, size: int):
    """(record starts below end, exit) of the chain that begins at pos; exit
    is -1 where the chain ends or breaks below ``end``."""
    import numpy as np

    eof = base + len(buf) >= size
    starts, _, reject, consumed = _record_starts(memoryview(buf)[pos - base:], final=eof)
    starts = np.asarray(starts, np.int64) + pos
    cut = int(np.searchsorted(starts, end))
    if cut < len(starts):
        return starts[:cut], int(starts[cut])
    if reject is not None:
        at = reject[0] + pos
        return starts, at if at >= end else -1
    if eof:  # a rest shorter than a header ends the file
        return starts, -1
    return starts, consumed + pos


def entry_exits(buf, start: int, end: int, size: int):
    """(entries, exits) of one range; ``buf`` holds the file from ``start``
    to OVERLAP bytes past ``end`` (or the file's end). Entries whose chain
    does not leave the range are left out."""
    import numpy as np

    data = np.frombuffer(buf, np.uint8)
    entries = np.arange(start, min(start + MAX_RECORD, size)) if start else np.zeros(1, np.int64)
    # where the chain of every offset before the frontier passes it: jumps of
    # one record, doubled until none lands before the frontier
    frontier = min(start + 2 * MAX_RECORD, end)
    pos = np.arange(start, frontier)
    whole = pos + HEADER_SIZE <= size
    at = np.where(whole, pos - start, 0)
    length = (data[np.minimum(at + 10, len(data) - 1)].astype(np.int64) << 8) | data[np.minimum(at + 11, len(data) - 1)]
    ahead = pos + HEADER_SIZE + length
    jump = np.where(whole & (length >= PAYLOAD_MIN) & (length < 32768) & (ahead <= size), ahead, -1)
    while len(on := np.flatnonzero((jump >= 0) & (jump < frontier))):
        jump[on] = jump[jump[on] - start]
    near = entries < frontier
    node = np.where(near, jump[np.where(near, entries - start, 0)], entries) if len(jump) else entries.copy()
    node, owner = np.unique(node, return_inverse=True)
    out, walked = node.copy(), []
    for k in np.flatnonzero((node >= 0) & (node < end)):
        for starts, left in walked:
            i = int(np.searchsorted(starts, node[k]))
            if i < len(starts) and starts[i] == node[k]:
                out[k] = left
                break
        else:
            walked.append(_follow(buf, start, int(node[k]), end, size))
            out[k] = walked[-1][1]
    exits = out[owner]
    return entries[exits >= 0], exits[exits >= 0]


def _ranges(files: DataFrame, range_bytes: int) -> DataFrame:
    n = F.greatest(F.ceil(F.col("length") / range_bytes), F.lit(1)).cast("int")
    rows = files.select("path", F.col("length").alias("size"), F.explode(F.sequence(F.lit(0), n - 1)).alias("range_id"))
    return rows.select("path", "size", "range_id", (F.col("range_id").cast("long") * range_bytes).alias("start"),
                       F.least((F.col("range_id").cast("long") + 1) * range_bytes, "size").alias("end"))


def _read(path: str, start: int, end: int, size: int) -> bytes:
    from busframes.sources.recording_source import open_file

    with open_file(path) as f:
        return bytes(f.read_at(min(end + OVERLAP, size) - start, start))


def pack_map(entries, exits) -> bytes:
    """A map (sorted distinct entries, their exits) in few bytes. Entries at
    the end that map to themselves are kept as a span; of the others, which
    lie in less than MAX_RECORD offsets and leave at few places, a number of
    the exit per offset (0: no entry), deflated."""
    import zlib

    import numpy as np

    n = len(entries)
    own = (exits == entries) & (entries - np.arange(n) == (entries[-1] - n + 1 if n else 0))
    k = n - int(np.argmin(own[::-1])) if not own.all() else 0  # own from k on
    places, number = np.unique(exits[:k], return_inverse=True)
    first = int(entries[0]) if k else 0
    codes = np.zeros(int(entries[k - 1]) - first + 1 if k else 0, np.uint16)
    codes[entries[:k] - first] = number + 1
    span = (int(entries[k]), int(entries[-1]) + 1) if k < n else (0, 0)
    return np.array([first, *span, len(places)], np.int64).tobytes() + zlib.compress(places.astype(np.int64).tobytes() + codes.tobytes(), 1)


def unpack_map(packed: bytes):
    """(entries, exits) of ``pack_map``."""
    import zlib

    import numpy as np

    first, begin, end, n = np.frombuffer(packed, np.int64, 4).tolist()
    rest = zlib.decompress(packed[32:])
    places, codes = np.frombuffer(rest, np.int64, n), np.frombuffer(rest, np.uint16, offset=8 * n)
    at, own = np.flatnonzero(codes), np.arange(begin, end)
    return np.concatenate([at + first, own]), np.concatenate([places[codes[at].astype(np.int64) - 1], own])


def _maps(batches) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        for a in range(0, batch.num_rows, 64):
            rows = batch.slice(a, 64)
            maps = [pack_map(*entry_exits(_read(r["path"], r["start"], r["end"], r["size"]), r["start"], r["end"], r["size"])) for r in rows.to_pylist()]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(maps, pa.binary())], [*rows.schema.names, "map"])


def compose(first, second):
    """The map that follows ``first`` by ``second``: (entries, exits) each,
    entries sorted. An entry whose chain ends in between is left out. (An exit
    beyond the second's range is among its entries and maps to itself.)"""
    import numpy as np

    (entries, middle), (known, exits) = first, second
    at = np.minimum(np.searchsorted(known, middle), max(len(known) - 1, 0))
    on = known[at] == middle if len(known) else np.zeros(len(middle), bool)
    return entries[on], exits[at[on]]


def _composed(batches) -> Iterator:
    """One map per block, from maps sorted by (path, block, range_id)."""
    import pyarrow as pa

    def out(r, m):
        return pa.RecordBatch.from_pydict({
            "path": [r["path"]], "range_id": pa.array([r["block"]], pa.int32()),
            "map": pa.array([pack_map(*m)], pa.binary())})

    last = held = None
    for batch in batches:
        for r in batch.to_pylist():
            if last is not None and (r["path"], r["block"]) == (last["path"], last["block"]):
                held = compose(held, unpack_map(r["map"]))
            else:
                if last is not None:
                    yield out(last, held)
                held = unpack_map(r["map"])
            last = r
    if last is not None:
        yield out(last, held)


def _walked(batches) -> Iterator:
    """Each map's true entry, from maps sorted by (path, block, range_id) that
    carry their block's entry (``at``)."""
    import numpy as np
    import pyarrow as pa

    now, at = None, -1
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if (r["path"], r["block"]) != now:
                now, at = (r["path"], r["block"]), r["at"]
            if at < 0:
                continue
            rows.append((r["path"], r["range_id"], at))
            entries, exits = unpack_map(r["map"])
            i = int(np.searchsorted(entries, at))
            at = int(exits[i]) if i < len(entries) and entries[i] == at else -1
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64()))], ["path", "range_id", "entry"])


def range_entries(files: DataFrame, range_bytes: int) -> DataFrame:
    """(path, size, start, end, entry): where each range's first record lies,
    checkpointed. Ranges that no record begins in are left out."""
    from busframes.session import checkpoint_base, ship_package

    spark = files.sparkSession
    checkpoint_base(spark)
    ship_package(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = "path string, size bigint, range_id int, start bigint, end bigint, map binary"

    def blocks(maps: DataFrame) -> DataFrame:
        block = F.floor(F.col("range_id") / BLOCK).cast("int")
        return maps.select("path", "range_id", block.alias("block"), "map")

    def by_block(maps: DataFrame) -> DataFrame:
        return maps.repartition(parts, "path", "block").sortWithinPartitions("path", "block", "range_id")

    # a range is a task's worth of work: spread them before reading
    ranges = _ranges(files, range_bytes).repartition(parts, "path", "range_id").mapInArrow(_maps, kind).checkpoint()
    most = ranges.agg(F.max("range_id")).first()[0] or 0
    levels = [ranges]
    while most >= BLOCK:
        levels.append(by_block(blocks(levels[-1])).mapInArrow(_composed, "path string, range_id int, map binary").checkpoint())
        most //= BLOCK
    walked = None
    for maps in reversed(levels):
        each = blocks(maps)
        if walked is None:
            each = each.withColumn("at", F.lit(0).cast("bigint"))  # one block a file, from its beginning
        else:
            above = walked.select(F.col("path").alias("_path"), F.col("range_id").alias("_block"), F.col("entry").alias("at"))
            each = each.join(above, (F.col("path") == F.col("_path")) & (F.col("block") == F.col("_block"))).drop("_path", "_block")
        walked = by_block(each).mapInArrow(_walked, "path string, range_id int, entry bigint").checkpoint()
    found = walked.withColumnsRenamed({"path": "_path", "range_id": "_id"})
    plain = ranges.select("path", "size", "range_id", "start", "end")
    return (plain.join(found, (F.col("path") == F.col("_path")) & (F.col("range_id") == F.col("_id")))
            .filter(F.col("entry") < F.col("end")).select("path", "size", "start", "end", "entry").checkpoint())


def read_ranges(files: DataFrame, range_bytes: int, where=None) -> DataFrame:
    """Framed rows (FRAMED_SCHEMA) of recordings (path, length), each framed
    by one task per range."""
    def frame(batches) -> Iterator:
        import numpy as np

        for batch in batches:
            for r in batch.to_pylist():
                start, end, size, pos = r["start"], r["end"], r["size"], r["entry"]
                buf = _read(r["path"], start, end, size)
                rest = memoryview(buf)[pos - start:]
                starts, lens, reject, _ = _record_starts(rest, final=start + len(buf) >= size)
                n = int(np.searchsorted(np.asarray(starts, np.int64), end - pos))
                if reject is not None and reject[0] + pos >= end:
                    reject = None
                yield from _framed(r["path"], rest, starts[:n], lens[:n], reject, pos, where)

    entry = range_entries(files, range_bytes)
    parts = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return entry.repartition(parts, "path", "start").mapInArrow(frame, FRAMED_SCHEMA)
