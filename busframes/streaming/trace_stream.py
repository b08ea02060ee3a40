"""Incremental decoding of traces as they land in a folder.

Each micro-batch takes at most ``max_files_per_trigger`` new files, parses
them once, joins the frames with the (static) dictionary and appends the
message-partitioned long table; lines and records that don't parse go to a
second table. Both are written under ``batch=<number>`` and a batch that runs
again replaces its own partitions, so a restart neither loses nor repeats
rows. Which files were taken is Spark's own log in the checkpoint (whatever
their time stamps); the checkpoint lies beside the output unless named, so a
restarted query goes on where it stopped.
"""

from __future__ import annotations

from typing import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from busframes.operators.decode import decode_frames_long, decode_text_long
from busframes.sources.binary_trace import split_framed
from busframes.sources.dictionary import SignalDictionary
from busframes.sources.recording_source import REMEMBER, frame_files, new_recordings
from busframes.sources.text_trace import ParsedTrace, keep_frame_lines, parse_text_lines, split_parsed


def _start(rows: DataFrame, split: Callable[[DataFrame], ParsedTrace], decode: Callable[[DataFrame], DataFrame],
           output_path: str, rejects_path: str | None, checkpoint: str | None, available_now: bool) -> StreamingQuery:
    out = output_path.rstrip("/")
    rejected = rejects_path or f"{out}_rejects"

    def store(df: DataFrame, batch: int, path: str, *by: str) -> None:
        (df.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch", *by).parquet(path))

    def take(batch: DataFrame, number: int) -> None:
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)  # one trigger's files, parsed once
        try:
            parsed = split(batch)
            store(decode(parsed.frames), number, out, "botschaft")
            store(parsed.rejects, number, rejected)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint or f"{out}_checkpoint")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def decode_text_stream(spark: SparkSession, input_dir: str, dictionary: SignalDictionary,
                       output_path: str, checkpoint: str | None = None, rejects_path: str | None = None,
                       max_files_per_trigger: int = 100, available_now: bool = True) -> StreamingQuery:
    """Text logs as they land. With ``available_now`` the query takes what is
    there, in batches, and stops."""
    lines = (spark.readStream.format("text").option("maxFilesPerTrigger", str(max_files_per_trigger))
             .option("maxFileAge", REMEMBER).load(input_dir)
             .select("value", F.col("_metadata.file_path").alias("source")))
    parsed = parse_text_lines(keep_frame_lines(lines), source_col="source")
    return _start(parsed, split_parsed, lambda f: decode_text_long(f, dictionary).drop("pos"),
                  output_path, rejects_path, checkpoint, available_now)


def decode_binary_stream(spark: SparkSession, input_dir: str, dictionary: SignalDictionary,
                         output_path: str, checkpoint: str | None = None, glob: str | None = None,
                         rejects_path: str | None = None, max_files_per_trigger: int = 100,
                         available_now: bool = True) -> StreamingQuery:
    """Binary recordings as they land, framed in bounded chunks."""
    framed = frame_files(new_recordings(spark, input_dir, glob, max_files_per_trigger))
    return _start(framed, split_framed, lambda f: decode_frames_long(f.drop("cs"), dictionary).drop("pos"),
                  output_path, rejects_path, checkpoint, available_now)
