"""Recordings as files: listed by Spark, read in the tasks.

Spark's ``binaryFile`` source lists files, directories and globs of any Hadoop
URI (relative and default-file-system paths too) and packs small files into
shared partitions; only path and length are asked for, so no content is read
into rows. Tasks open the files through pyarrow's file-system layer and frame
them in bounded chunks.
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_CHUNK = 8 << 20
MIN_CHUNK = 64 << 10  # > 12-byte header + the largest 16-bit payload
#: every file that was ever there is remembered, whatever its time stamp
REMEMBER = "36500d"


def open_file(uri: str):
    """A random-access file for a path as Spark lists it."""
    from pyarrow import fs as pafs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:"):]
    if uri.startswith("s3a://"):
        uri = "s3://" + uri[len("s3a://"):]
    if uri.startswith("file://"):
        from urllib.parse import unquote

        filesystem, path = pafs.LocalFileSystem(), unquote(uri[len("file://"):])
    else:
        filesystem, path = pafs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(path)


def list_recordings(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """(path, length) of every recording under ``path``."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def new_recordings(spark: SparkSession, path: str, glob: str | None, max_files: int) -> DataFrame:
    """The same as a stream of files as they land, at most ``max_files`` per
    batch. Spark's file source keeps what it has taken in the checkpoint."""
    reader = (spark.readStream.format("binaryFile").option("recursiveFileLookup", "true")
              .schema("path string, modificationTime timestamp, length bigint, content binary")
              .option("maxFilesPerTrigger", str(max_files)).option("maxFileAge", REMEMBER))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length")


def frame_files(files: DataFrame, chunk_bytes: int = DEFAULT_CHUNK, where=None) -> DataFrame:
    """Framed rows of whole recordings, each read by one task in chunks.
    ``where`` (a FrameFilter): other frames are never built."""
    from busframes.session import ship_package
    from busframes.sources.binary_trace import FRAMED_SCHEMA

    ship_package(files.sparkSession)
    chunk = max(chunk_bytes, MIN_CHUNK)

    def run(batches) -> Iterator:
        from busframes.sources.binary_trace import frame_stream

        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_file(path) as f:
                    yield from frame_stream(f.read, path, chunk, where)

    return files.select(F.col("path")).mapInArrow(run, FRAMED_SCHEMA)
