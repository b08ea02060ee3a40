"""Job runner over written traces, and the incremental stream."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from busframes import fixtures as fx
from busframes.plans.jobs import JOBS, Target, run, with_overrides
from busframes.plans.views import export_message_tables, register_message_views
from busframes.sources import SignalDictionary
from busframes.streaming import decode_binary_stream, decode_text_stream

SF = "/root/testdata/sf0.001"


def _inputs(spark, tmp_dir):
    frames = fx.raw_frames(fx.lineitem(spark, SF))
    text_dir, bin_dir = f"{tmp_dir}/text", f"{tmp_dir}/bin"
    fx.text_trace_lines(spark, frames).write.text(text_dir)
    fx.write_blobs(fx.binary_blobs(fx.raw_frames(fx.lineitem(spark, SF), with_file_key=True)), bin_dir)
    return frames, text_dir, bin_dir, SignalDictionary.load(fx.dictionary_rows(spark))


def test_matrix_has_18_jobs():
    assert len(JOBS) == 18
    assert [j.name for j in JOBS.values() if j.dictionary == "test"] == ["BasicModelTD", "BasicModelCK"]
    assert {j.sink for j in JOBS.values()} == {"module_tables", "preview", "message_tables",
                                              "statements", "rows", "points"}


def test_jobs_end_to_end(spark, tmp_dir):
    frames, text_dir, bin_dir, d = _inputs(spark, tmp_dir)
    n = frames.count()
    n_decoded = frames.filter(F.col("id").between(101, 105)).count() + frames.filter("id = 101").count()

    out = f"{tmp_dir}/by-module"
    res = run(spark, JOBS["BasicModelTD"], text_dir, d, Target(path=out, rejects_path=f"{tmp_dir}/rejects"))
    assert res.metrics == {"delivered": n, "rejected": 1}  # the fixture's event line
    assert spark.read.parquet(f"{tmp_dir}/rejects").first().reason == "too few tokens"
    back = spark.read.parquet(out)
    assert back.count() == n and sorted(r.module for r in back.select("module").distinct().collect()) == [1, 2]

    out = f"{tmp_dir}/messages"
    assert run(spark, JOBS["HexToCK_2"], bin_dir, d, Target(path=out)).metrics["delivered"] == n_decoded
    assert spark.read.parquet(out).count() == n_decoded
    views = register_message_views(spark, out, d)
    assert views[103, "MSG_103"] == "msg_MSG_103"
    wide = spark.sql("SELECT * FROM msg_MSG_103")
    assert wide.columns == ["ts", "id", "orderkey", "partkey", "mid", "flag", "qty"]
    assert wide.count() == frames.filter("id = 103").count()
    exported = export_message_tables(
        spark, out, d, lambda df, t: df.write.mode("overwrite").parquet(f"{tmp_dir}/tables/{t}"),
        table_for=lambda i, b: b.lower())
    assert sorted(exported) == ["msg_101", "msg_102", "msg_103", "msg_104", "msg_105", "msg_alt"]
    assert spark.read.parquet(f"{tmp_dir}/tables/msg_alt").columns == ["ts", "id", "orderkey"]
    check = spark.sql("SELECT count(*) AS n, sum(qty) AS q FROM msg_MSG_103").first()
    li = fx.lineitem(spark, SF).filter("l_linenumber = 3")
    assert check.n == li.count() and check.q == li.agg(F.sum(F.col("l_quantity").cast("bigint"))).first()[0]

    out = f"{tmp_dir}/messages-text"
    run(spark, JOBS["ModelCKPartition"], text_dir, d, Target(path=out))
    assert spark.read.parquet(out).count() == n_decoded

    out = f"{tmp_dir}/statements"
    shaped = run(spark, with_overrides("HexToTD_3", message_id=103), bin_dir, d, Target(path=out)).shaped
    stmts = [json.loads(line) for p in glob.glob(f"{out}/*.jsonl") for line in open(p)]
    n103 = frames.filter("id = 103").count()
    assert sum(s["n_rows"] for s in stmts) == 11 * n103 == shaped.agg(F.sum("n_rows")).first()[0]
    assert all(s["statement"].startswith("INSERT INTO Datalogger2_MSG_103 USING MSG_103 TAGS (2,\"Datalogger2\")")
               for s in stmts)

    out = f"{tmp_dir}/points"
    assert run(spark, JOBS["HexToInflux_2"], bin_dir, d, Target(path=out)).metrics["delivered"] == n_decoded
    points = [json.loads(line) for p in glob.glob(f"{out}/*.jsonl") for line in open(p)]
    assert len(points) == n_decoded

    out = f"{tmp_dir}/preview"
    run(spark, JOBS["ModelCK"], text_dir, d, Target(path=out))
    assert spark.read.json(out).count() == 100


def _line(i, sec=1):
    return f"   {sec}.{i:06d} 1  67       Rx   d 8 01 02 03 04 05 06 07 08"


def _text_file(folder, name, lines, mtime=None):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    if mtime:
        os.utime(path, (mtime, mtime))


def _recording(folder, name, n, mtime=None, tail=b""):
    import struct

    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "wb") as f:
        f.write(b"".join(struct.pack(">iibbhii", 1, i, 1, 0, 16, 103, 0x80000) + bytes(range(1, 9)) for i in range(n)) + tail)
    if mtime:
        os.utime(path, (mtime, mtime))


def test_text_stream_restarts_without_a_named_checkpoint(spark, tmp_dir):
    d = SignalDictionary.load(fx.dictionary_rows(spark))
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    _text_file(src, "a.asc", [_line(i) for i in range(4)] + ["   1.0 Start of measurement"])
    decode_text_stream(spark, src, d, out).awaitTermination(300)
    assert spark.read.parquet(out).count() == 4 * 5
    # lands later, with an older time stamp
    _text_file(src, "b.asc", [_line(i, 2) for i in range(3)] + ["   1.0 1  67       Rx   d 8 01"], mtime=1_000_000_000)
    decode_text_stream(spark, src, d, out).awaitTermination(300)
    assert spark.read.parquet(out).count() == 7 * 5
    decode_text_stream(spark, src, d, out).awaitTermination(300)  # nothing new
    assert spark.read.parquet(out).count() == 7 * 5
    assert sorted(r.reason for r in spark.read.parquet(f"{out}_rejects").collect()) == ["payload differs from byte count", "too few tokens"]
    assert os.path.isdir(f"{out}_checkpoint/offsets")


def test_binary_stream_takes_late_files_in_bounded_batches(spark, tmp_dir):
    d = SignalDictionary.load(fx.dictionary_rows(spark))
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    for k in range(5):
        _recording(src, f"r{k}.bin", 3, tail=b"\0" * 13 if k == 2 else b"")
    _recording(src, "other.txt", 3)
    decode_binary_stream(spark, src, d, out, glob="*.bin", max_files_per_trigger=2).awaitTermination(300)
    back = spark.read.parquet(out)
    assert back.count() == 5 * 3 * 5 and back.select("batch").distinct().count() == 3
    _recording(src, "late.bin", 4, mtime=1_000_000_000)
    decode_binary_stream(spark, src, d, out, glob="*.bin", max_files_per_trigger=2).awaitTermination(300)
    assert spark.read.parquet(out).count() == (5 * 3 + 4) * 5
    assert spark.read.parquet(f"{out}_rejects").count() == 1


def test_other_source_sink_combinations(spark, tmp_dir):
    frames, text_dir, bin_dir, d = _inputs(spark, tmp_dir)
    n = frames.count()
    out = f"{tmp_dir}/bin-by-module"
    res = run(spark, with_overrides("BasicModelTD", source="binary"), bin_dir, d, Target(path=out))
    back = spark.read.parquet(out)
    assert res.metrics["delivered"] == n and back.filter("len = 8").count() == n
    out = f"{tmp_dir}/csv"
    res = run(spark, with_overrides("HexToCK_2", sink="csv"), bin_dir, d, Target(path=out))
    back = spark.read.option("header", "true").csv(out)
    assert set(back.columns) == {"ts", "id", "signal_name", "value", "botschaft"}
    assert back.count() == res.metrics["delivered"]


def test_small_recordings_share_tasks_by_their_bytes(spark, tmp_dir):
    """F8: many small recordings, few tasks, all frames."""
    from busframes.sources.binary_trace import read_binary_trace

    n, cores = 400, spark.sparkContext.defaultParallelism
    blobs = fx.binary_blobs(spark.range(n).select(F.col("id").alias("file_key"), F.col("id").alias("ts"), F.lit(101).alias("id"), F.lit(1).cast("smallint").alias("module"),
                                                  F.array(*map(F.lit, range(8))).alias("data")))
    fx.write_blobs(blobs, "file://" + tmp_dir + "/many")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")  # a listing with a task per recording
    try:
        frames = read_binary_trace(spark, tmp_dir + "/many").frames
        assert frames.rdd.getNumPartitions() <= 4 * cores < n
        assert sorted(r.ts for r in frames.select("ts").collect()) == list(range(n))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def _own_lineitem(spark, tmp_dir):
    spark.range(200).select(F.floor(F.col("id") / 5).alias("l_orderkey"), (F.col("id") * 7).alias("l_partkey"), (F.col("id") * 3).alias("l_suppkey"),
                            (1 + F.col("id") % 5).cast("int").alias("l_linenumber"), F.lit(9.0).alias("l_quantity")).write.parquet(f"{tmp_dir}/sf/lineitem.parquet")
    return f"{tmp_dir}/sf"


def _spied(monkeypatch, module):
    """The rows that ``insert_statements`` gets there."""
    seen, make = [], module.insert_statements
    monkeypatch.setattr(module, "insert_statements", lambda decoded, *a, **k: seen.append(decoded) or make(decoded, *a, **k))
    return seen


@pytest.mark.parametrize("name,rows", [("HexToTD", 240), ("HexToTD_3", 11 * 40)])
def test_statement_jobs_scan_their_trace_once(spark, tmp_dir, monkeypatch, name, rows):
    """numbering reads the decoded rows from where they were stored."""
    from busframes.plans import jobs

    seen = _spied(monkeypatch, jobs)
    fx.write_blobs(fx.binary_blobs(fx.raw_frames(fx.lineitem(spark, _own_lineitem(spark, tmp_dir)), with_file_key=True)), f"file://{tmp_dir}/bin")
    d = SignalDictionary.load(fx.dictionary_rows(spark), persist=False)
    res = run(spark, with_overrides(name, message_id=103 if rows != 240 else None), f"file://{tmp_dir}/bin", d, Target(path=f"file://{tmp_dir}/out"))
    assert len(seen) == 1 and seen[0].inputFiles() and all("/decoded-rows-" in f for f in seen[0].inputFiles())
    assert res.shaped.agg(F.sum("n_rows")).first()[0] == rows


def test_grouped_statements_parse_their_lines_once(spark, tmp_dir, monkeypatch):
    """the same for text lines."""
    from busframes.plans import catalog

    seen = _spied(monkeypatch, catalog)
    out = catalog.q_insert_statements_grouped(spark, _own_lineitem(spark, tmp_dir))
    assert out.agg(F.sum("n_rows")).first()[0] == 240
    assert len(seen) == 1 and seen[0].inputFiles() and all("/decoded-rows-" in f for f in seen[0].inputFiles())
