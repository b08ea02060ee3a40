"""Frames of indexed recordings in time order, without a sort of all frames.

A global sort samples every frame for its bounds and moves every frame to its
range. The time index already tells where each chunk lies in time, so the time
axis is cut by it alone (about equal numbers of frames a range), and not the
frames but the chunks' descriptions are dealt: each range's task opens the
chunks that touch it, builds only the records of its span and sorts these.
Recordings whose times overlap meet in the ranges where they do.

A chunk is opened once for each range it touches: recordings run forward in
time, so most touch one. Where that would read more than ``most_reads`` times
the index's chunks (recordings out of order), each chunk is opened once and
the frames move to their range instead; the rows and their order are the same.

Order: ts, then id, module, data. Frames of one ts share a range, whose sort
spills. Rejects are not in it (see ``read_indexed``); an empty index gives one
empty range.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.operators.ranges import MAX_CUTS, cuts_below, cuts_of, literal_cuts, range_number
from busframes.sources.binary_trace import FRAMED_SCHEMA, split_framed
from busframes.sources.frame_filter import FrameFilter
from busframes.sources.time_index import frame_range, read_indexed

RANGE_FRAMES = 2 << 20
ORDER = ("ts", "id", "module", "data")
PIECES = 8  # of a range: how finely chunks are weighed


def time_cuts(index: DataFrame, range_frames: int = RANGE_FRAMES) -> list[int]:
    """Times that cut the index's frames into ranges of about that many, from
    the index alone: a chunk counts by its frames, spread over its span."""
    chunks = index.filter(F.col("n") > 0)
    total = chunks.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = min(-(-total // range_frames), MAX_CUTS + 1)
    if ranges < 2:
        return []
    unit = max(1, total // (ranges * PIECES))
    spread = (chunks.withColumn("k", F.greatest(F.lit(1), F.floor(F.col("n") / unit))).withColumn("i", F.explode(F.expr("sequence(1L, k)")))
              .select((F.col("min_ts") + F.floor((F.col("max_ts") - F.col("min_ts")) * ((2 * F.col("i") - 1) / (2 * F.col("k"))))).alias("ts")))
    return sorted(set(spread.agg(cuts_of(F.col("ts"), ranges)).first()[0] or []))


def dealt_chunks(index: DataFrame, cuts: list[int]) -> DataFrame:
    """A row for each chunk and range that it touches: path, entry, stop,
    range, ts_from and ts_to (inclusive; null: no bound)."""
    at = literal_cuts(cuts)
    touched = F.sequence(cuts_below(F.col("min_ts"), at, len(cuts)), cuts_below(F.col("max_ts"), at, len(cuts)))
    return index.filter(F.col("n") > 0).withColumn("range", F.explode(touched)).select(
        "path", "entry", "stop", "range", F.get(at, F.col("range") - 1).alias("ts_from"), (F.get(at, F.col("range")) - 1).alias("ts_to"))


def time_ordered(index: DataFrame, range_frames: int = RANGE_FRAMES, most_reads: float = 3.0) -> DataFrame:
    """All frames (module, ts, id, data, cs); partition k holds the k-th range
    of time, sorted, so files written from it are in time order."""
    from busframes.session import ship_package

    ship_package(index.sparkSession)
    cuts = time_cuts(index, range_frames)
    dealt = dealt_chunks(index, cuts)
    chunks, reads = index.filter(F.col("n") > 0).count(), dealt.count()
    if reads > most_reads * chunks + len(cuts):
        frames = read_indexed(index).frames
        return frames.repartitionById(len(cuts) + 1, range_number(F.col("ts"), cuts)).sortWithinPartitions(*ORDER)

    def run(batches) -> Iterator:
        for batch in batches:
            for r in batch.to_pylist():
                yield from frame_range(r["path"], r["entry"], r["stop"], FrameFilter(ts_from=r["ts_from"], ts_to=r["ts_to"]))

    framed = dealt.repartitionById(len(cuts) + 1, F.col("range")).mapInArrow(run, FRAMED_SCHEMA)
    return split_framed(framed).frames.sortWithinPartitions(*ORDER)
