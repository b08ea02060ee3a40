"""Parallel framing of single recordings equals a sequential walk."""

import os
import random
import struct

import pytest

from busframes.sources.binary_trace import _frame_one
from busframes.sources.recording_source import list_recordings
from busframes.sources.split_framing import OVERLAP, entry_exits, read_ranges


def _record(sec, ns, port, canid, cs, data):
    payload = struct.pack(">ii", canid, cs) + bytes(data)
    return struct.pack(">iibbh", sec, ns, 1, port, len(payload)) + payload


def _expected(path):
    blob = open(path, "rb").read()
    m, cols, reject, _ = _frame_one(blob, path)
    rows = []
    if m:
        offsets, values = cols["data"]
        for k in range(m):
            rows.append((int(cols["position"][k]), int(cols["id"][k]), int(cols["ts"][k]),
                         tuple(int(v) for v in values[offsets[k]:offsets[k + 1]]), None))
    if reject is not None:
        rows.append((reject[0], None, None, None, reject[1]))
    return rows


def _got(df, path):
    return sorted((r.position, r.id, r.ts, None if r.data is None else tuple(r.data), r.reason)
                  for r in df.collect() if r.source.endswith(os.path.basename(path)))


def _files(tmp_dir):
    rnd = random.Random(11)
    files = {}
    uniform = b"".join(_record(1, i * 7, 0, i, 0x80000, [i % 256] * 8) for i in range(400))
    mixed = b"".join(_record(2, i, 1, i, 0, [rnd.randint(0, 255) for _ in range(rnd.choice([0, 2, 8, 8, 64]))])
                     for i in range(400))
    # a 32 KiB payload made of valid-looking inner records: a speculative
    # boundary inside it follows a fake chain and must be corrected
    inner = b"".join(_record(9, 9, 0, 0xBAD, 0, [0xEE] * 8) for _ in range(1169))
    trap = (_record(3, 0, 0, 1, 0, [1] * 8) + _record(3, 1, 0, 2, 0, list(inner))
            + b"".join(_record(3, 2 + i, 0, 3 + i, 0, [2] * 8) for i in range(300)))
    broken = (b"".join(_record(4, i, 0, i, 0, [3] * 8) for i in range(100))
              + struct.pack(">iibbh", 4, 0, 1, 0, 4) + b"\x00" * 40
              + b"".join(_record(4, i, 0, i, 0, [3] * 8) for i in range(50)))
    truncated = b"".join(_record(5, i, 0, i, 0, [4] * 8) for i in range(120)) + _record(5, 0, 0, 0, 0, [1] * 8)[:15]
    for name, blob in [("uniform", uniform), ("mixed", mixed), ("trap", trap), ("broken", broken),
                       ("truncated", truncated), ("empty", b"")]:
        path = os.path.join(tmp_dir, f"{name}.bin")
        with open(path, "wb") as f:
            f.write(blob)
        files[name] = path
    return files


def _split_local(blob: bytes, split: int):
    """The algorithm without Spark: maps, composition, framing."""
    from busframes.sources.binary_trace import _record_starts

    size, at, starts, rejects = len(blob), 0, [], []
    for start in range(0, max(size, 1), split):
        end = min(start + split, size)
        buf = blob[start: min(end + OVERLAP, size)]
        entries, exits = entry_exits(buf, start, end, size) if size else ([], [])
        if not 0 <= at < end:
            continue
        rel, _, reject, _ = _record_starts(memoryview(buf)[at - start:], final=start + len(buf) >= size)
        starts += [int(x) + at for x in rel if x + at < end]
        if reject is not None and reject[0] + at < end:
            rejects.append((reject[0] + at, reject[1]))
        at = dict(zip(entries.tolist(), exits.tolist())).get(at, -1)
    return sorted(starts), rejects


def test_split_algorithm_random_files():
    from busframes.sources.binary_trace import _record_starts

    rnd = random.Random(3)
    inner = b"".join(_record(9, 9, 0, 0xBAD, 0, [0xEE] * 8) for _ in range(300))
    for trial in range(10):
        recs = []
        for i in range(rnd.randint(0, 120)):
            kind = rnd.random()
            if kind < 0.05:
                recs.append(_record(1, i, 0, i, 0, list(inner)))        # fake chain inside a payload
            else:
                recs.append(_record(1, i, 0, i, 0, [rnd.randint(0, 255) for _ in range(rnd.choice([0, 1, 8, 8, 64]))]))
        blob = b"".join(recs)
        tail = rnd.random()
        if tail < 0.2:
            blob += b"\x01\x02\x03"
        elif tail < 0.4 and recs:
            blob += recs[0][:rnd.randint(12, len(recs[0]) - 1)]
        elif tail < 0.5:
            blob += struct.pack(">iibbh", 1, 0, 1, 0, 3) + b"\x00" * 30 + blob[:200]
        starts, lens, reject, _ = _record_starts(blob, final=True)
        for split in (700, 5000, 10**6):
            got, rejects = _split_local(blob, split)
            assert got == [int(x) for x in starts], (trial, split)
            assert rejects == ([reject] if reject else []), (trial, split)


def test_maps_of_every_entry():
    """Each entry's exit, against a plain walk from it."""
    rnd = random.Random(8)
    blob = b"".join(_record(1, i, 0, i, 0, [rnd.choice([0, 0, 16, 200]) for _ in range(rnd.choice([0, 8, 8, 64]))]) for i in range(200))
    start, end, size = 1000, 4000, len(blob)
    entries, exits = entry_exits(blob[start:end + OVERLAP], start, end, size)
    got = dict(zip(entries.tolist(), exits.tolist()))
    for e in range(start, size):
        pos = e
        while 0 <= pos < end:
            length = struct.unpack_from(">h", blob, pos + 10)[0] if pos + 12 <= size else -1
            pos = pos + 12 + length if length >= 8 and pos + 12 + length <= size else -1
        assert got.get(e, -1) == pos, e


@pytest.mark.parametrize("payload", [[0, 16] * 4, list(range(8)), [0, 0, 0, 16, 0, 0, 0, 16]])
def test_mimicking_payloads_cost_one_walk(payload):
    """Payload bytes that look like headers leave few chains to follow."""
    import time

    blob = b"".join(_record(1, i, 0, 16, 16, payload) for i in range(150_000))
    begun = time.process_time()
    entries, exits = entry_exits(blob[28_000:], 28_000, len(blob) - OVERLAP, len(blob))
    assert len(entries) and time.process_time() - begun < 10


@pytest.mark.parametrize("split", [997, 1 << 20])
def test_split_equals_sequential(spark, tmp_dir, split):
    files = _files(tmp_dir)
    df = read_ranges(list_recordings(spark, tmp_dir), split).cache()
    for name, path in files.items():
        assert _got(df, path) == sorted(_expected(path)), (name, split)
    df.unpersist()


def test_read_binary_trace_splits_large_recordings(spark, tmp_dir):
    from busframes.sources.binary_trace import read_binary_trace

    blob = b"".join(_record(7, i * 1000, 0, i % 50, 0x80000, [i % 256] * 8) for i in range(3000))
    with open(os.path.join(tmp_dir, "big.bin"), "wb") as f:
        f.write(blob)
    whole = read_binary_trace(spark, tmp_dir)                                   # one task
    split = read_binary_trace(spark, tmp_dir, range_bytes=8_192)
    cols = ["module", "ts", "id", "cs"]
    assert sorted(tuple(r) for r in split.frames.select(*cols).collect()) == \
        sorted(tuple(r) for r in whole.frames.select(*cols).collect())
    assert split.frames.count() == 3000
    some = read_binary_trace(spark, tmp_dir, range_bytes=8_192, ids=(7, 9))
    assert some.frames.count() == 120 and {r.id for r in some.frames.select("id").distinct().collect()} == {7, 9}


def test_small_files_stay_packed_beside_a_large_one(spark, tmp_dir):
    from busframes.sources.binary_trace import read_binary_trace

    for i in range(40):
        with open(os.path.join(tmp_dir, f"s{i:03d}.bin"), "wb") as f:
            f.write(_record(1, i, 0, i, 0, [1] * 8))
    with open(os.path.join(tmp_dir, "zlarge.bin"), "wb") as f:
        f.write(b"".join(_record(2, i, 0, 99, 0, [2] * 8) for i in range(2000)))
    out = read_binary_trace(spark, tmp_dir, range_bytes=10_000).frames
    assert out.count() == 2040 and out.filter("id < 40").count() == 40
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    assert out.rdd.getNumPartitions() <= int(parts) + spark.sparkContext.defaultParallelism


def test_globs_and_relative_paths(spark, tmp_dir, monkeypatch):
    from busframes.sources.binary_trace import read_binary_trace

    for name in ("a.bin", "b.bin", "c.txt"):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(_record(1, 0, 0, 5, 0, [1] * 8))
    assert read_binary_trace(spark, f"{tmp_dir}/*.bin").frames.count() == 2
    assert read_binary_trace(spark, f"file://{tmp_dir}/a.bin").frames.count() == 1
    assert read_binary_trace(spark, os.path.relpath(tmp_dir), glob="*.bin").frames.count() == 2


def test_maps_compose_like_a_walk():
    """Composition is associative and follows the chains; passing over a
    range and chains that end are kept apart."""
    import numpy as np

    from busframes.sources.split_framing import compose

    a = (np.array([0, 1, 2, 3]), np.array([10, 12, 10, 25]))
    b = (np.array([10, 11, 12, 25]), np.array([20, 21, 22, 25]))  # 25 lies beyond b's range
    c = (np.array([20, 25]), np.array([30, 31]))
    left, right = compose(compose(a, b), c), compose(a, compose(b, c))
    assert [x.tolist() for x in left] == [x.tolist() for x in right] == [[0, 2, 3], [30, 30, 31]]
    assert [len(x) for x in compose(a, (np.zeros(0, np.int64),) * 2)] == [0, 0]


def test_many_ranges_go_through_blocks(spark, tmp_dir, monkeypatch):
    """More ranges than a block holds, in two levels of blocks: the rows of a
    sequential walk, and no group of more than a block's maps."""
    import random
    import struct

    from busframes.sources import split_framing as S
    from busframes.sources.binary_trace import read_binary_trace

    rng = random.Random(11)
    for k, n in enumerate((3000, 400, 1)):
        body = b""
        for i in range(n):
            data = bytes(rng.randrange(256) for _ in range(rng.choice([0, 8, 64, 300])))
            body += struct.pack(">iibbhii", i, 5, 1, 0, 8 + len(data), 100 + k, 0) + data
        with open(f"{tmp_dir}/r{k}.bin", "wb") as f:
            f.write(body)
    monkeypatch.setattr(S, "BLOCK", 4)
    rows = lambda df: sorted((r.module, r.ts, r.id, tuple(r.data)) for r in df.collect())
    want = rows(read_binary_trace(spark, tmp_dir).frames)
    got = read_binary_trace(spark, tmp_dir, range_bytes=6000)
    assert rows(got.frames) == want and len(want) == 3401
    from busframes.sources.recording_source import list_recordings

    entries = S.range_entries(list_recordings(spark, tmp_dir), 6000)
    assert entries.groupBy("path").count().agg({"count": "max"}).first()[0] > 16


def test_maps_are_packed_in_few_bytes():
    """Every entry and exit comes back, in an eighth of their own bytes."""
    import numpy as np
    from busframes.sources.split_framing import pack_map, unpack_map

    rnd = random.Random(21)
    blob = b"".join(_record(1, i, 0, 101 + i % 7, 0x80000, [rnd.randint(0, 255) for _ in range(8)]) for i in range(4000))
    for start, end in ((0, 16384), (16384, 32768), (98304, len(blob))):
        entries, exits = entry_exits(blob[start:end + OVERLAP], start, end, len(blob))
        packed = pack_map(entries, exits)
        assert [x.tolist() for x in unpack_map(packed)] == [entries.tolist(), exits.tolist()]
        assert 8 * len(packed) <= 16 * len(entries) or not start
    for entries, exits in (([], []), ([5], [5]), ([5, 7], [7, 7]), ([3, 4, 6, 7], [3, 9, 6, 7]), ([1, 2], [8, 9])):
        entries, exits = np.array(entries, np.int64), np.array(exits, np.int64)
        assert [x.tolist() for x in unpack_map(pack_map(entries, exits))] == [entries.tolist(), exits.tolist()]
