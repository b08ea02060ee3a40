"""Binary recording framing: uniform and mixed lengths, tails, truncation."""

import os
import struct

from busframes.sources.binary_trace import frame_records, read_binary_trace, split_framed


def _record(sec, ns, port, canid, cs, data):
    payload = struct.pack(">ii", canid, cs) + bytes(data)
    return struct.pack(">iibbh", sec, ns, 1, port, len(payload)) + payload


def _frame(spark, blobs):
    df = spark.createDataFrame([(f"f{i}", b) for i, b in enumerate(blobs)], "path string, content binary")
    return split_framed(frame_records(df))


def test_uniform_records_and_tail(spark):
    blob = b"".join(_record(1601253345, 70147999 + i, 0, 0x7A + i, 0x00080000, [i] * 8) for i in range(5))
    out = _frame(spark, [blob + b"\x01\x02\x03\x04\x05"])
    rows = sorted(out.frames.collect(), key=lambda r: r.id)
    assert [r.id for r in rows] == [0x7A + i for i in range(5)]
    assert rows[0].ts == 1601253345070147 and rows[0].module == 1 and rows[0].data == [0] * 8
    assert out.rejects.count() == 0


def test_mixed_lengths_signed_fields(spark):
    blob = (_record(10, 999, -1, 0x18DAF110, -1, [255, 1])
            + _record(11, 1000, 3, 0x100, 0x00080000, list(range(8)))
            + _record(12, 0, 0, 5, 0, list(range(64))))
    rows = sorted(_frame(spark, [blob]).frames.collect(), key=lambda r: r.ts)
    assert [(r.ts, r.module, r.id, r.cs, len(r.data)) for r in rows] == [
        (10000000, 0, 0x18DAF110, -1, 2), (11000001, 4, 0x100, 0x00080000, 8), (12000000, 1, 5, 0, 64)]
    assert rows[0].data == [255, 1]


def test_truncated_and_short_records(spark):
    good = _record(1, 0, 0, 1, 0, [1] * 8)
    truncated = good + good[:-3]
    bad_len = good + struct.pack(">iibbh", 2, 0, 1, 0, 4) + b"\x00" * 4
    out = _frame(spark, [truncated, bad_len])
    assert out.frames.count() == 2
    reasons = sorted(r.reason for r in out.rejects.collect())
    assert reasons[0].startswith("payload length 4") and reasons[1] == "truncated record"


def test_file_scan(spark, tmp_dir):
    with open(os.path.join(tmp_dir, "a.bin"), "wb") as f:
        f.write(_record(1, 0, 0, 9, 0, [7] * 8))
    with open(os.path.join(tmp_dir, "b.txt"), "wb") as f:
        f.write(b"not a trace")
    out = read_binary_trace(spark, tmp_dir, glob="*.bin")
    assert [r.id for r in out.frames.collect()] == [9]


def test_streamed_source_equals_whole_file(spark, tmp_dir):
    import random

    from busframes.sources.recording_source import frame_files, list_recordings

    rnd = random.Random(5)
    for k in range(3):
        recs = [_record(k, i * 1000, k, 0x100 + i % 7, 0x00080000, [rnd.randint(0, 255)] * rnd.choice([8, 8, 2, 64]))
                for i in range(3000)]
        blob = b"".join(recs)
        if k == 1:
            blob += b"\x00\x01\x02"        # tail under a header: ignored
        if k == 2:
            blob += recs[0][:20]           # truncated record: one reject
        with open(os.path.join(tmp_dir, f"r{k}.bin"), "wb") as f:
            f.write(blob)
    cols = ["position", "module", "ts", "id", "cs", "data", "reason"]
    whole = sorted(tuple(r) for r in frame_records(
        spark.read.format("binaryFile").load(tmp_dir).select("path", "content")).select(*cols).collect())
    # chunks of 64 KiB force many chunk boundaries inside each file
    streamed = sorted(tuple(r) for r in frame_files(list_recordings(spark, tmp_dir), chunk_bytes=1).select(*cols).collect())
    assert streamed == whole and len(whole) == 9001
    out = read_binary_trace(spark, tmp_dir, glob="r1.bin")
    assert out.frames.count() == 3000 and out.rejects.count() == 0


def test_frame_stream_chunk_boundaries():
    import io

    from busframes.sources.binary_trace import frame_stream

    recs = [_record(1, i, 0, i, 0, [i % 256] * (8 if i % 3 else 64)) for i in range(500)]
    blob = b"".join(recs) + recs[0][:30]
    for chunk in (97, 1000, 1 << 20):
        batches = list(frame_stream(io.BytesIO(blob).read, "s", chunk))
        frames = [r for b in batches for r in b.to_pylist() if r["reason"] is None]
        rejects = [r for b in batches for r in b.to_pylist() if r["reason"] is not None]
        assert [f["id"] for f in frames] == list(range(500))
        assert rejects == [{"source": "s", "position": len(blob) - 30, "module": None, "ts": None, "id": None,
                            "cs": None, "data": None, "reason": "truncated record"}]
