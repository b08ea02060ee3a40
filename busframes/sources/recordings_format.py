"""Recordings as a Spark data source: ``spark.read.format("recordings")``.

Conditions on ``id``, ``module`` and ``ts`` are pushed into the scan: they
select chunks by the time index (option ``index``, see ``time_index``) and
records by their headers, so nothing is built for a record that doesn't
qualify. Without an index, files under ``path`` are read whole, packed into
tasks of ``task_bytes``.

The plan's list of chunks lies on the driver, as the list of files of any file
source does; ``time_index.read_indexed`` keeps it in a table instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual,
)

from busframes.sources.binary_trace import FRAMED_SCHEMA
from busframes.sources.frame_filter import FrameFilter

NAME = "recordings"
TASK_BYTES = 64 << 20


@dataclass
class Chunks(InputPartition):
    """Chunks of one task: (path, entry, stop, reject position, reason);
    stop None: the whole file."""
    chunks: list

    def __init__(self, chunks: list):
        self.chunks = chunks


def _pushed(where: FrameFilter, f) -> FrameFilter | None:
    """``where`` and this condition, or None if it can't be checked here."""
    column = f.attribute[0] if len(f.attribute) == 1 else None
    if isinstance(f, IsNotNull):
        return where if column in ("id", "module", "ts", "position", "source", "cs", "data") else None
    if isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None or isinstance(f, In) and None not in f.value:
        values = f.value if isinstance(f, In) else (f.value,)
        if column == "id":
            return where.and_ids(values)
        if column == "module":
            return where.and_modules(values)
        if column == "ts" and len(values) == 1:
            return where.and_ts(values[0], values[0])
    if column == "ts" and isinstance(f, (GreaterThan, GreaterThanOrEqual)):
        return where.and_ts(low=f.value + isinstance(f, GreaterThan))
    if column == "ts" and isinstance(f, (LessThan, LessThanOrEqual)):
        return where.and_ts(high=f.value - isinstance(f, LessThan))
    return None


class RecordingReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.where = FrameFilter()
        self.frames_only = False  # a condition that no reject row meets

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, IsNull) and f.attribute == ("reason",):
                self.frames_only = True
                continue
            more = _pushed(self.where, f)
            if more is None:
                yield f
            else:
                self.where = more
                self.frames_only |= f.attribute[0] not in ("source", "position")

    def _listed(self):
        from pyarrow import fs as pafs

        path = self.options["path"]
        filesystem, root = pafs.FileSystem.from_uri(path)
        infos = filesystem.get_file_info([root])
        if infos[0].type == pafs.FileType.Directory:
            infos = filesystem.get_file_info(pafs.FileSelector(root, recursive=True))
        scheme = path.split("://")[0] + "://" if "://" in path else "file://"
        for i in sorted(infos, key=lambda i: i.path):
            if i.type == pafs.FileType.File and not i.base_name.startswith(("_", ".")):
                yield f"{scheme}{i.path}", 0, None, None, None, i.size

    def _indexed(self):
        import pyarrow.dataset as ds
        from pyarrow import fs as pafs

        filesystem, root = pafs.FileSystem.from_uri(self.options["index"])
        table = ds.dataset(root, filesystem=filesystem, format="parquet")
        some = None
        for c in [x for x in (self.where.ts_from is not None and (ds.field("max_ts") >= self.where.ts_from),
                              self.where.ts_to is not None and (ds.field("min_ts") <= self.where.ts_to)) if x is not False]:
            some = c if some is None else some & c
        for batch in table.to_batches(filter=some):
            for r in batch.to_pylist():
                if self.where.may_hold(r["min_ts"], r["max_ts"], r["ids"]) or (r["reason"] is not None and not self.frames_only):
                    yield r["path"], r["entry"], r["stop"], r["reject_at"], r["reason"], r["stop"] - r["entry"]

    def partitions(self):
        limit, held, size, out = int(self.options.get("task_bytes", TASK_BYTES)), [], 0, []
        for *chunk, n in self._indexed() if "index" in self.options else self._listed():
            if held and size + n > limit:
                out.append(Chunks(held))
                held, size = [], 0
            held.append(tuple(chunk))
            size += n
        return out + [Chunks(held)]

    def read(self, partition):
        from busframes.sources.binary_trace import frame_stream
        from busframes.sources.recording_source import DEFAULT_CHUNK, open_file
        from busframes.sources.time_index import frame_range

        for path, entry, stop, at, reason in partition.chunks:
            if stop is None:
                with open_file(path) as f:
                    batches = frame_stream(f.read, path, DEFAULT_CHUNK, self.where)
                    yield from self._rows(batches)
            else:
                yield from self._rows(frame_range(path, entry, stop, self.where, (at, reason)))

    def _rows(self, batches):
        for b in batches:
            if not (self.frames_only and b.num_rows and b.column("reason")[0].is_valid):  # rejects come in batches of their own
                yield b


class RecordingFormat(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return FRAMED_SCHEMA

    def reader(self, schema) -> RecordingReader:
        return RecordingReader(self.options)


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let it take filters."""
    from busframes.session import ship_package

    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RecordingFormat)


def read_recordings(spark: SparkSession, path: str | None = None, index: str | None = None) -> DataFrame:
    """Framed rows (FRAMED_SCHEMA) of the recordings under ``path``, or of
    those that the time index stored at ``index`` knows."""
    register(spark)
    reader = spark.read.format(NAME)
    return (reader.option("index", index) if index else reader.option("path", path)).load()
