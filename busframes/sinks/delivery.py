"""Delivery of shaped rows to external stores.

Spark's own writers where one exists (JDBC, parquet, CSV). For stores without
a Spark writer, ``deliver`` runs ``foreachPartition`` with a client factory
called on the executor, sending fixed-size batches; each partition opens one
client. That delivery is at-least-once: a retried task re-sends its partition.
Clients that can stage and publish get each row once (``committed``).
"""

from __future__ import annotations

import json
import uuid
from typing import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jdbc(df: DataFrame, url: str, table: str, options: dict | None = None,
               batch_rows: int = 10_000, mode: str = "append") -> None:
    """Append through Spark's JDBC writer, ``batch_rows`` rows per batch."""
    (df.write.format("jdbc").mode(mode)
     .option("url", url).option("dbtable", table).option("batchsize", str(batch_rows))
     .options(**(options or {})).save())


def write_by_key(df: DataFrame, key: str, write: Callable[[DataFrame, object], None]) -> list:
    """``write(rows of the key, key value)`` per key value (e.g. one table
    per bus module).

    The rows are written once, one directory per key value in the shared
    folder, and each call reads its own directory: the input runs once and no
    row is read twice. The key values (a handful of modules or a dictionary's
    messages) are what the directories name.
    """
    from busframes.operators.partition import write_partitioned
    from busframes.session import shared_dir

    spark = df.sparkSession
    path = shared_dir(spark, "by-key")
    write_partitioned(df, path, [key], within=[])
    stored = spark.read.schema(df.schema).parquet(path)
    keys = [r[0] for r in stored.select(key).distinct().collect()]
    for k in keys:
        write(stored.filter(F.col(key).eqNullSafe(F.lit(k))).select(*[c for c in df.columns if c != key]), k)
    return keys


def write_jdbc_by_key(df: DataFrame, key: str, url: str, table_for: Callable[[object], str],
                      options: dict | None = None, batch_rows: int = 10_000) -> list:
    """One JDBC table per key value."""
    return write_by_key(df, key, lambda rows, k: write_jdbc(rows, url, table_for(k), options, batch_rows))


def deliver(df: DataFrame, client_factory: Callable[[], object], batch_rows: int) -> int:
    """Send each partition's rows in batches of ``batch_rows`` through a
    client made on the executor: ``client.send(list_of_dicts)``,
    ``client.close()``. Rows reach Python as Arrow batches and are re-cut
    to ``batch_rows``, so a task holds at most one batch at a time. Returns
    the number of rows delivered."""
    from busframes.session import ship_package

    ship_package(df.sparkSession)

    def run(batches):
        import pyarrow as pa

        client = client_factory()
        sent = 0
        pending = []
        try:
            for batch in batches:
                pending.extend(batch.to_pylist())
                while len(pending) >= batch_rows:
                    client.send(pending[:batch_rows])
                    sent += batch_rows
                    pending = pending[batch_rows:]
            if pending:
                client.send(pending)
                sent += len(pending)
        finally:
            client.close()
        yield pa.RecordBatch.from_pydict({"sent": [sent]})

    total = df.mapInArrow(run, "sent bigint").agg(F.sum("sent")).first()[0]
    return int(total or 0)


class RecordingClient:
    """A client that records each batch as one JSON-lines file (for tests and
    dry runs); ``root`` is a shared folder, opened through pyarrow's
    file-system layer so local and distributed paths work alike."""

    def __init__(self, root: str):
        self.root = root
        self._fs = None

    def _open(self):
        from pyarrow import fs as pafs

        if self._fs is None:
            self._fs, self._path = pafs.FileSystem.from_uri(self.root)
            self._fs.create_dir(self._path, recursive=True)

    def send(self, batch: list) -> None:
        self._open()
        name = f"{self._path}/batch-{uuid.uuid4().hex}.jsonl"
        with self._fs.open_output_stream(name) as f:
            for row in batch:
                f.write((json.dumps(row, default=str) + "\n").encode())

    def close(self) -> None:
        pass
