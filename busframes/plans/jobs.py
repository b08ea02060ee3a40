"""Job specifications: 18 job variants as data, one runner.

A job is source x replay x decode x filter x sink. ``run`` executes one:
dictionary -> trace scan -> (replay) -> (one-message filter, pushed before
the join) -> decode -> shape -> deliver. Errors propagate (a failed job
fails; nothing is printed and swallowed).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from busframes.functions.bits import bytes_to_hex, idiv
from busframes.functions.timefmt import micros_to_millis_timestamp, micros_to_string
from busframes.operators.batching import staged
from busframes.operators.decode import decode_frames_array, decode_text_array
from busframes.operators.partition import count_rows, preview, write_partitioned
from busframes.operators.shape import long_from_array, replay
from busframes.plans.views import export_message_tables
from busframes.session import checkpoint_base, shared_dir
from busframes.sinks.committed import RecordingStore, deliver_committed
from busframes.sinks.delivery import deliver, write_by_key, write_jdbc
from busframes.sinks.shaping import insert_statements, line_protocol, wide_store_rows
from busframes.sources import SignalDictionary, read_binary_trace, read_text_trace
from busframes.sources.binary_trace import split_framed
from busframes.sources.text_trace import ParsedTrace, split_parsed


@dataclass(frozen=True)
class JobSpec:
    name: str
    source: str                    # "text" | "binary"
    decode: str                    # "none" | "map" (by name: a repeated name keeps its last layout) | "array"
    sink: str                      # see SINKS
    replay: bool = False           # 11-day replay of binary frames
    message_id: int | None = None  # keep one message (filter on id before the join)
    batch_rows: int = 10_000
    device: str = "Datalogger1"
    tag_number: int = 2
    prefix: str = ""
    suffix: str = ""
    preview_rows: int = 5
    dictionary: str = "full"       # which of the caller's dictionary tables (full or test)
    ts_millis: bool = False        # message tables bind ts as a timestamp of whole ms
    options: dict = field(default_factory=dict, compare=False)


# The job matrix (source, decode, sink, replay, filter, batch size).
JOBS = {j.name: j for j in [
    JobSpec("BasicModelTD", "text", "none", "module_tables", dictionary="test"),
    JobSpec("BasicModelCK", "text", "none", "preview", message_id=402522483, preview_rows=100, dictionary="test"),
    JobSpec("ModelMySQL", "text", "map", "preview", message_id=1157, preview_rows=100),
    JobSpec("ModelCK", "text", "map", "preview", preview_rows=100),
    JobSpec("ModelMySQLPartition", "text", "map", "message_tables", batch_rows=50_000),
    JobSpec("ModelCKPartition", "text", "map", "message_tables", batch_rows=50_000),
    JobSpec("HexToCK", "binary", "array", "message_tables", batch_rows=50_000),
    JobSpec("HexToCK_2", "binary", "array", "message_tables", batch_rows=30_000, ts_millis=True),
    JobSpec("HexToCK_3", "binary", "array", "message_tables", replay=True, message_id=168, batch_rows=30_000, ts_millis=True),
    JobSpec("HexToMYSQL_2", "binary", "array", "message_tables", batch_rows=10_000, ts_millis=True),
    JobSpec("HexToMYSQL_3", "binary", "array", "message_tables", replay=True, message_id=168, batch_rows=10_000, ts_millis=True),
    JobSpec("HexToTD", "binary", "array", "statements", batch_rows=20_000, suffix="_1_2"),
    JobSpec("HexToTD_2", "binary", "array", "statements", batch_rows=5_000, prefix="Datalogger1_"),
    JobSpec("HexToTD_3", "binary", "array", "statements", replay=True, message_id=168, batch_rows=5_000,
            prefix="Datalogger2_", device="Datalogger2"),
    JobSpec("HexToCassandra_1", "binary", "array", "rows", batch_rows=1_000),
    JobSpec("HexToCassandra_3", "binary", "array", "rows", replay=True, message_id=168, batch_rows=10_000),
    JobSpec("HexToInflux_2", "binary", "array", "points", batch_rows=5_000),
    JobSpec("HexToInflux_3", "binary", "array", "points", replay=True, message_id=168, batch_rows=5_000),
]}


@dataclass
class Target:
    """Where a job's output goes. ``path``: a folder for file outputs and the
    recording client; ``jdbc_url`` + ``jdbc_options``: database tables;
    ``table_writer``: called as (rows, table, batch_rows) in place of the
    database writer; ``client_factory``: a store client made on each executor,
    which gets each row once if it can stage and publish (``sinks.committed``),
    at least once if it only sends; ``delivery``: a name for this delivery, so
    that a run repeated after it was published sends nothing."""
    path: str | None = None
    rejects_path: str | None = None
    jdbc_url: str | None = None
    jdbc_options: dict | None = None
    table_writer: Callable[[DataFrame, str, int], None] | None = None
    client_factory: Callable[[], object] | None = None
    delivery: str | None = None

    def tables(self) -> Callable[[DataFrame, str, int], None] | None:
        if self.table_writer is None and self.jdbc_url:
            return lambda df, table, rows: write_jdbc(df, self.jdbc_url, table, self.jdbc_options, rows)
        return self.table_writer

    def factory(self) -> Callable[[], object]:
        if self.client_factory is not None:
            return self.client_factory
        root = self.path
        return lambda: RecordingStore(root)

    def send(self, df: DataFrame, batch_rows: int) -> int:
        factory = self.factory()
        if hasattr(factory(), "publish"):
            return deliver_committed(df, factory, batch_rows, self.delivery)
        return deliver(df, factory, batch_rows)


def load_dictionary(spark: SparkSession, spec: JobSpec, tables: dict[str, str], jdbc_options: dict) -> SignalDictionary:
    """The job's dictionary table over JDBC (url, driver, user, password in
    ``jdbc_options``), aggregated, persisted and measured once. ``tables``
    names the caller's tables: ``full`` (the signal matrix) and ``test``."""
    from busframes.sources.dictionary import read_dictionary

    return SignalDictionary.load(read_dictionary(spark, tables[spec.dictionary], "jdbc", jdbc_options))


def _staged(spark: SparkSession, rows: DataFrame, split: Callable) -> ParsedTrace:
    """Parsed rows written once, so that frames and rejects read columns, not
    the trace again. Lines of good frames are not kept."""
    path = shared_dir(spark, "parsed-trace")
    if "line" in rows.columns:
        rows = rows.withColumn("line", F.when(F.col("reject").isNotNull(), F.col("line")))
    rows.write.parquet(path)
    return split(spark.read.parquet(path))


def scan_with_rejects(spark: SparkSession, spec: JobSpec, trace_path: str, stage: bool = False):
    """Trace scan + one-message filter, plus the rejected lines/records;
    ``stage`` when both are wanted.
    Raw frames for binary traces, text frames (hex payload) for text traces.
    The replay is applied after the decode (see ``run``)."""
    if spec.source == "text":
        parsed = read_text_trace(spark, trace_path)
        if stage:
            parsed = _staged(spark, parsed.rows, split_parsed)
        frames = parsed.frames
    elif spec.source == "binary":
        ids = None if spec.message_id is None else (spec.message_id,)
        parsed = read_binary_trace(spark, trace_path, ids=ids)  # other frames are never built
        if stage:
            parsed = _staged(spark, parsed.rows, split_framed)
        frames = parsed.frames.drop("cs")
    else:
        raise ValueError(f"unknown source {spec.source!r}")
    if spec.message_id is not None:
        frames = frames.filter(F.col("id") == F.lit(spec.message_id))
    return frames, parsed.rejects


def scan(spark: SparkSession, spec: JobSpec, trace_path: str) -> DataFrame:
    return scan_with_rejects(spark, spec, trace_path)[0]


def decode(frames: DataFrame, spec: JobSpec, dictionary: SignalDictionary) -> DataFrame:
    if spec.decode == "none":
        return frames
    if spec.decode == "map":
        return decode_text_array(frames, dictionary, with_names=True)
    if spec.decode == "array":
        return decode_frames_array(frames, dictionary, with_names=True)
    raise ValueError(f"unknown decode {spec.decode!r}")


def shape(decoded: DataFrame, spec: JobSpec, most_signals: int = 0) -> DataFrame:
    """The rows the sink receives. ``most_signals``: of a message, where known."""
    if spec.sink == "module_tables":
        if spec.source == "text":   # ts in ns since trace start, data as hex text
            return decoded.select("module", micros_to_string(idiv("ts", 1000)).alias("ts"), "id", "len", "data")
        return decoded.select("module", micros_to_string("ts").alias("ts"), "id",   # binary: µs, byte array
                              F.size("data").cast("smallint").alias("len"), bytes_to_hex("data").alias("data"))
    if spec.sink == "preview":
        cols = [c for c in ("ts", "id", "module", "botschaft") if c in decoded.columns]
        return preview(decoded, spec.preview_rows, cols)
    if spec.sink == "count":
        return count_rows(decoded)
    if spec.sink == "message_tables":
        # names are per message: kept in the dictionary, not on every row
        return decoded.select("botschaft", "ts", "id", "vals")
    if spec.sink == "statements":
        return insert_statements(decoded, spec.batch_rows, prefix=spec.prefix, suffix=spec.suffix,
                                 device=spec.device, tag_number=spec.tag_number)
    if spec.sink == "rows":
        return wide_store_rows(decoded, spec.device)
    if spec.sink == "points":
        return line_protocol(decoded, spec.device, most_signals)
    if spec.sink == "csv":
        return long_from_array(decoded).drop("pos")
    raise ValueError(f"unknown sink {spec.sink!r}")


def deliver_shaped(shaped: DataFrame, spec: JobSpec, target: Target, dictionary: SignalDictionary) -> int | None:
    """Write or send the shaped rows; returns the number delivered (observed
    during the delivering pass itself), or None for the JDBC path."""
    from pyspark.sql import Observation

    spark = shaped.sparkSession
    seen = Observation(f"{spec.name}-delivered")
    if spec.sink == "module_tables":
        if target.tables():
            checkpoint_base(spark)
            write_by_key(shaped, "module", lambda df, m: target.tables()(df, f"datalogger_1_can{m}", spec.batch_rows))
            return None
        write_partitioned(shaped, target.path, ["module"], observation=seen)
    elif spec.sink == "message_tables":
        path = target.path or shared_dir(spark, "message-rows")
        write_partitioned(shaped, path, ["botschaft"], observation=seen)
        if target.tables():
            bind = (lambda df: df.withColumn("ts", micros_to_millis_timestamp("ts"))) if spec.ts_millis else (lambda df: df)
            export_message_tables(spark, path, dictionary, lambda df, t: target.tables()(df, t, spec.batch_rows), shape=bind)
    elif spec.sink == "csv":
        write_partitioned(shaped, target.path, ["botschaft"], fmt="csv", options={"header": "true"},
                          observation=seen)
    elif spec.sink in ("preview", "count"):
        shaped.observe(seen, F.count(F.lit(1)).alias("delivered")).write.mode("overwrite").json(target.path)
    else:
        return target.send(shaped, spec.batch_rows if spec.sink != "statements" else 1)
    return int(seen.get["delivered"])


@dataclass
class JobResult:
    shaped: DataFrame
    metrics: dict


def run(spark: SparkSession, spec: JobSpec, trace_path: str, dictionary: SignalDictionary,
        target: Target) -> JobResult:
    """Run one job end to end. Returns the shaped DataFrame it delivered and
    the number of rows delivered, observed during the delivering pass itself
    (``DataFrame.observe`` / the delivery's own count; no extra pass)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    frames, rejects = scan_with_rejects(spark, spec, trace_path, stage=bool(target.rejects_path))
    decoded = decode(frames, spec, dictionary)
    if spec.sink == "statements":   # numbering reads its rows three times
        decoded = staged(decoded.select("botschaft", "ts", "id", "vals"), "decoded-rows")
    if spec.replay:
        # decoding does not depend on ts: replaying decoded rows gives the
        # same rows as decoding replayed frames, with 1/11 of the decode work
        decoded = replay(decoded)
    shaped = shape(decoded, spec, dictionary.most_signals)
    delivered = deliver_shaped(shaped, spec, target, dictionary)
    metrics = {"delivered": delivered}
    if target.rejects_path:
        rejects.write.mode("overwrite").parquet(target.rejects_path)
        metrics["rejected"] = spark.read.parquet(target.rejects_path).count()
    return JobResult(shaped, metrics)


def with_overrides(name: str, **changes) -> JobSpec:
    """A job of the matrix with some fields changed (e.g. the message id)."""
    return replace(JOBS[name], **changes)
