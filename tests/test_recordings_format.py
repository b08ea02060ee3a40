"""Pushed filters, the time index and the table function against full scans."""

import os
import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull, LessThanOrEqual, StringContains

from busframes.sources import binary_trace as B
from busframes.sources.binary_trace import read_binary_trace
from busframes.sources.frame_filter import FrameFilter
from busframes.sources.recordings_format import RecordingReader, read_recordings
from busframes.sources.time_index import build_time_index, chunks_for, read_indexed


def _record(sec, ns, port, canid, data):
    payload = struct.pack(">ii", canid, len(data) << 16) + bytes(data)
    return struct.pack(">iibbh", sec, ns, 1, port, len(payload)) + payload


def _write(folder, files=6, frames=9000, seed=1):
    """Recordings with rising times, mixed lengths; one cut, one empty."""
    rng = random.Random(seed)
    os.makedirs(f"{folder}/deep", exist_ok=True)
    for k in range(files):
        body, sec = b"", 1000 * k
        for _ in range(frames):
            sec += rng.random() < 0.1
            body += _record(sec, rng.randrange(10**9), rng.randrange(-1, 3), rng.choice([7, 101, 102, 0x18DAF110, -5]), [rng.randrange(256)] * rng.choice([0, 3, 8, 64]))
        with open(f"{folder}/{'deep/' if k % 2 else ''}part {k}.bin", "wb") as f:
            f.write(body + (_record(1, 2, 0, 3, [1] * 8)[:-2] if k == 2 else b""))
    open(f"{folder}/nothing.bin", "wb").close()
    return folder


def _rows(df):
    return sorted((r.module, r.ts, r.id, r.cs, tuple(r.data)) for r in df.collect())


@pytest.fixture(scope="module")
def traces(spark, tmp_path_factory):
    folder = _write(str(tmp_path_factory.mktemp("rec")))
    index = f"file://{folder}-index"
    build_time_index(spark, folder, chunk_bytes=1 << 16).write.parquet(index)
    return f"file://{folder}", index


CASES = ["id = 101", "id IN (7, -5) AND ts >= 2000000000", "ts BETWEEN 1005000000 AND 1100000000", "module = 2 AND ts < 50000000",
         "ts = -1", "id = 101 AND length(string(cs)) > 3", "module <=> 1 OR id = 7", "id = 418050320 AND id = 7"]


@pytest.mark.parametrize("condition", CASES)
def test_pushed_filters_keep_the_rows(spark, traces, condition):
    folder, index = traces
    want = _rows(read_binary_trace(spark, folder).frames.filter(condition))
    assert _rows(read_recordings(spark, folder).filter(condition).filter("reason IS NULL")) == want
    assert _rows(read_recordings(spark, index=index).filter(condition).filter("reason IS NULL")) == want


def test_the_scan_takes_the_filter(spark, traces):
    df = read_recordings(spark, index=traces[1])
    plan = df.filter("id = 101 AND ts > 5 AND reason IS NULL")._jdf.queryExecution().executedPlan().toString()
    assert "BatchScan recordings" in plan and "Filter (" not in plan
    rest = df.filter("id = 101 AND length(source) > 5")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (length(source" in rest and "= 101" not in rest


def test_rejects_stay_in_the_table(spark, traces):
    folder, index = traces
    want = sorted((os.path.basename(r.source), r.position, r.reason) for r in read_binary_trace(spark, folder).rejects.collect())
    assert len(want) == 1
    for df in (read_recordings(spark, folder), read_recordings(spark, index=index)):
        assert sorted((os.path.basename(r.source), r.position, r.reason) for r in df.filter("reason IS NOT NULL").collect()) == want
        assert df.filter("id IS NOT NULL AND reason IS NOT NULL").count() == 0
    assert read_indexed(spark.read.parquet(index)).rejects.count() == 1


def test_records_that_dont_qualify_are_never_built(traces, monkeypatch):
    built = []
    decode = B._decode_records
    monkeypatch.setattr(B, "_decode_records", lambda content, starts, lengths: built.append(len(starts)) or decode(content, starts, lengths))
    for options in ({"path": traces[0]}, {"index": traces[1]}):
        reader, built[:] = RecordingReader(options), []
        left = list(reader.pushFilters([EqualTo(("id",), 101), GreaterThan(("ts",), 3_000_000_000), IsNotNull(("id",)), StringContains(("source",), "x"),
                                        In(("module",), (0, 1, 2)), LessThanOrEqual(("ts",), 3_050_000_000)]))
        assert [type(f).__name__ for f in left] == ["StringContains"]
        rows = sum(b.num_rows for p in reader.partitions() for b in reader.read(p))
        assert 0 < rows == sum(built) < 1000
        opened = sum(len(p.chunks) for p in reader.partitions())
    assert opened < 6  # of some 40 chunks


def test_index_opens_few_chunks(spark, traces):
    index = spark.read.parquet(traces[1])
    whole = index.count()
    frames = read_binary_trace(spark, traces[0]).frames
    some = frames.orderBy("ts").limit(3000).orderBy(F.desc("ts")).first()
    where = FrameFilter(ids=(some.id,), ts_from=some.ts, ts_to=some.ts)
    chunks = chunks_for(index, where)
    assert whole > 30 and 1 <= chunks.count() <= 3
    assert _rows(read_indexed(index, where).frames) == _rows(frames.filter((F.col("id") == some.id) & (F.col("ts") == some.ts)))
    assert chunks_for(index, FrameFilter(ids=(123456,))).count() < whole  # ids by bitmap
    plan = chunks_for(index, where)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(max_ts), IsNotNull(min_ts)" in plan


@pytest.mark.parametrize("range_bytes", [1 << 17, 1 << 30])
def test_index_covers_every_record_once(spark, traces, range_bytes):
    index = build_time_index(spark, traces[0], chunk_bytes=1 << 16, range_bytes=range_bytes).cache()
    assert _rows(read_indexed(index).frames) == _rows(read_binary_trace(spark, traces[0]).frames)
    assert index.agg(F.sum("n")).first()[0] == read_binary_trace(spark, traces[0]).frames.count()
    by = {}
    for r in index.orderBy("path", "entry").collect():
        assert by.get(r.path, 0) == r.entry
        by[r.path] = r.stop
    index.unpersist()


def test_table_function(spark, traces):
    from busframes.plans.table_function import register_decode_trace
    from busframes.sources import SignalDictionary

    rows = [(101, "A", "low", 0, 8), (101, "A", "far", 96, 8), (7, "B", "low", 0, 8)]
    d = SignalDictionary.load(spark.createDataFrame(rows, "identifier int, botschaft string, signal_name string, startBit int, len int"), persist=False)
    name = register_decode_trace(spark, traces[1], d)
    df = spark.sql(f"SELECT signal_name, count(*) AS n, sum(value) AS total FROM {name}('%part 3%', 101, 3000000000, 3100000000) GROUP BY signal_name")
    frames = read_recordings(spark, traces[0]).filter("source LIKE '%part 3%' AND id = 101 AND ts BETWEEN 3000000000 AND 3100000000").collect()
    low = [r.data[0] for r in frames if r.data]
    assert {(r.signal_name, r.n, r.total) for r in df.collect()} == {("low", len(frames), sum(low)), ("far", len(frames), sum(r.data[12] for r in frames if len(r.data) > 12))}
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = plan[:plan.index("BatchScan recordings")].splitlines()
    assert not any("id#" in line and "= 101" in line for line in scan[-2:])  # taken by the scan
    assert spark.sql(f"SELECT * FROM {name}(NULL, NULL, NULL, NULL)").count() > 10_000
