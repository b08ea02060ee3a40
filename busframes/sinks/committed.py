"""Committed delivery: a store sees each row of a job once.

``deliver_committed`` writes through Spark's data source writer: every task
stages its batches with a client of its own, and what its last attempt staged
travels to the driver as the task's commit message. Only when all tasks are
done does the job publish these stages, in one decision; a task that fails
half-way and runs again, or runs twice, leaves nothing of the attempt that
doesn't count. A job is known by its name: run again after it was published,
it sends nothing.

A client (made on each executor and on the driver by a factory):

- ``begin(job)``: a new stage; ``send(rows)``: add a batch to it;
- ``prepare() -> str``: make the stage durable, return its name;
  ``rollback()``: drop it;
- ``published(job) -> int | None``: rows of a job published before;
- ``publish(job, stages, rows)``: make all stages visible, or none;
  ``discard(job, stages)``: drop them.

``RecordingStore`` keeps the rows as JSON lines in a shared folder. For stores
with transactions, a stage is a staging table or an open transaction's name.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def _values(column) -> list:
    """What ``to_pylist`` gives, by whole columns where their type allows it."""
    import pyarrow as pa

    t = column.type
    if pa.types.is_list(t):
        flat, sizes = _values(column.flatten()), column.value_lengths().to_pylist()
        out, at = [], 0
        for n in sizes:
            out.append(None if n is None else flat[at:at + n])
            at += n or 0
        return out
    if pa.types.is_string(t) or pa.types.is_decimal(t) or (pa.types.is_integer(t) and not column.null_count):
        return column.to_numpy(zero_copy_only=False).tolist()
    if pa.types.is_timestamp(t) and t.unit == "us" and t.tz == "UTC":
        zone = pa.scalar(0, t).as_py().tzinfo
        plain = column.cast(pa.timestamp("us")).to_numpy(zero_copy_only=False).tolist()
        return [None if v is None else v.replace(tzinfo=zone) for v in plain]
    return column.to_pylist()


def _rows(batch) -> list[dict]:
    """The rows of an Arrow batch as dicts."""
    names = batch.schema.names
    return [dict(zip(names, r)) for r in zip(*map(_values, batch.columns))]


_encode = json.JSONEncoder(default=str).encode


@dataclass
class Staged(WriterCommitMessage):
    """What one task staged; no stage where it had no rows."""
    stage: str | None
    rows: int


class StoreWriter(DataSourceArrowWriter):
    def __init__(self, factory: Callable[[], object], job: str, batch_rows: int):
        self.factory, self.job, self.batch_rows = factory, job, batch_rows

    def write(self, iterator) -> Staged:
        client = self.factory()
        if client.published(self.job) is not None:
            return Staged(None, 0)
        held, sent = [], 0
        client.begin(self.job)
        try:
            for batch in iterator:
                held.extend(_rows(batch))
                while len(held) >= self.batch_rows:
                    client.send(held[:self.batch_rows])
                    sent += self.batch_rows
                    held = held[self.batch_rows:]
            if held:
                client.send(held)
                sent += len(held)
            return Staged(client.prepare() if sent else None, sent)
        except BaseException:
            client.rollback()
            raise

    def commit(self, messages) -> None:
        client = self.factory()
        if client.published(self.job) is None:
            done = [m for m in messages if m is not None and m.stage is not None]
            client.publish(self.job, [m.stage for m in done], sum(m.rows for m in done))

    def abort(self, messages) -> None:
        self.factory().discard(self.job, [m.stage for m in messages if m is not None and m.stage is not None])


def store_format(factory: Callable[[], object], batch_rows: int) -> type[DataSource]:
    """A data source that writes through clients of ``factory``."""
    class CommittedStore(DataSource):
        @classmethod
        def name(cls) -> str:
            return "committed_store"

        def writer(self, schema, overwrite: bool) -> StoreWriter:
            return StoreWriter(factory, self.options["job"], batch_rows)

    return CommittedStore


def deliver_committed(df: DataFrame, factory: Callable[[], object], batch_rows: int, job: str | None = None) -> int:
    """Deliver ``df`` once under the name ``job`` (default: a new one), in
    batches of ``batch_rows`` rows; a task holds one batch at a time. Returns
    the number of rows published under that name."""
    from busframes.session import ship_package

    spark = df.sparkSession
    ship_package(spark)
    job = job or uuid.uuid4().hex
    if factory().published(job) is None:
        spark.dataSource.register(store_format(factory, batch_rows))
        df.write.format("committed_store").option("job", job).mode("append").save()
    return int(factory().published(job) or 0)


class RecordingStore:
    """Rows as JSON-lines files in the folder ``root`` (any file system that
    pyarrow opens), one file per batch.

    Stages lie under ``_staged``, which readers of the folder don't see.
    Writing the job's list of files into ``_published`` (to a side name, then
    renamed) is the decision; then the files move to ``root``. ``recover``
    completes a job whose driver died in between."""

    def __init__(self, root: str):
        self.root = root
        self._fs = None
        self._job, self._stage, self._batches = "", "", 0

    def _open(self):
        from pyarrow import fs as pafs

        if self._fs is None:
            self._fs, self._path = pafs.FileSystem.from_uri(self.root)
            for d in ("_staged", "_published"):
                self._fs.create_dir(f"{self._path}/{d}", recursive=True)
        return self._fs

    def _write(self, path: str, text: str) -> None:
        with self._open().open_output_stream(path) as f:
            f.write(text.encode())

    def _files(self, folder: str) -> list[str]:
        from pyarrow import fs as pafs

        infos = self._open().get_file_info(pafs.FileSelector(folder, allow_not_found=True))
        return sorted(i.path for i in infos if i.type == pafs.FileType.File)

    def begin(self, job: str) -> None:
        self._job, self._stage, self._batches = job, uuid.uuid4().hex, 0
        self._open().create_dir(f"{self._path}/_staged/{job}/{self._stage}", recursive=True)

    def send(self, rows: list) -> None:
        self._batches += 1
        name = f"{self._path}/_staged/{self._job}/{self._stage}/batch-{self._stage}-{self._batches:06d}.jsonl"
        self._write(name, "".join(_encode(r) + "\n" for r in rows))

    def prepare(self) -> str:
        return self._stage

    def rollback(self) -> None:
        self.discard(self._job, [self._stage])

    def _entry(self, job: str) -> dict | None:
        from pyarrow import fs as pafs

        path = f"{self._path}/_published/{job}.json" if self._open() else ""
        if self._fs.get_file_info([path])[0].type != pafs.FileType.File:
            return None
        with self._fs.open_input_stream(path) as f:
            return json.loads(f.read().decode())

    def published(self, job: str) -> int | None:
        entry = self._entry(job)
        return None if entry is None else entry["rows"]

    def publish(self, job: str, stages: list[str], rows: int) -> None:
        self._open()
        side = f"{self._path}/_published/.{job}-{uuid.uuid4().hex}"
        self._write(side, json.dumps({"job": job, "rows": rows, "stages": stages}))
        self._fs.move(side, f"{self._path}/_published/{job}.json")
        self.recover(job)

    def recover(self, job: str) -> None:
        """Bring what a published job still has staged into the folder, and
        drop what other attempts of its tasks left."""
        entry = self._entry(job)
        if entry is None:
            return
        for stage in entry["stages"]:
            for f in self._files(f"{self._path}/_staged/{job}/{stage}"):
                self._fs.move(f, f"{self._path}/{f.rsplit('/', 1)[1]}")
        self._drop(f"{self._path}/_staged/{job}")

    def _drop(self, folder: str) -> None:
        from pyarrow import fs as pafs

        if self._open().get_file_info([folder])[0].type == pafs.FileType.Directory:
            self._fs.delete_dir(folder)

    def discard(self, job: str, stages: list[str]) -> None:
        self._open()
        for stage in stages:
            self._drop(f"{self._path}/_staged/{job}/{stage}")
