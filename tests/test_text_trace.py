"""Text log scan: tokeniser, prefix filter, rejects, file scan."""

import os

from busframes.sources.text_trace import (
    keep_frame_lines, parse_text_lines, read_text_trace, split_parsed,
)


def _parse(spark, lines):
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    return split_parsed(parse_text_lines(keep_frame_lines(df)))


def test_golden_lines(spark):
    out = _parse(spark, [
        "   0.003040 1  7A       Rx   d 1 10",
        "   0.000065 2  18DAF110x       Tx   d 8 10 50 01 2C 00 29 01 FC",
        "   0.003040 1  7A       Rx   d 0",
        "   0.003040 1  7A       Rx   d 12 10 50 01 2C 00 29 01 FC 00 00 00 00",
        "   0.000000 Start of measurement",
        "   0.000001 1  FFFFFFFF       Rx   d 1 10",
        "1000.000000 1  7A       Rx   d 8 10 50 01 2C 00 29 01 FC",
        "date Thu Dec 3 06:00:00.000 am 2026",
    ])
    frames = sorted(out.frames.collect(), key=lambda r: (r.ts, r.len))
    assert [(r.module, r.ts, r.id, r.dir, r.len, r.data) for r in frames] == [
        (2, 64999, 417001744, "Tx", 8, "10 50 01 2C 00 29 01 FC"),
        (1, 3040000, 122, "Rx", 1, "10"),
        (1, 3040000, 122, "Rx", 12, "10 50 01 2C 00 29 01 FC 00 00 00 00"),
    ]
    reasons = sorted(r.reason for r in out.rejects.collect())
    # zero-byte payload, event line, id beyond int
    assert reasons == ["bad id", "too few tokens", "too few tokens"]


def test_payload_is_never_cut(spark):
    long = " ".join(f"{i:02x}" for i in range(64))
    out = _parse(spark, [
        "   1.0 1  7A       Rx   d 8 1a 2b 3C 4d 5e 6f 70 81  Length = 240000 BitCount = 124 ID = 122",
        f"   2.0 1  7A       Rx   d 64 {long}",
        "   3.0 1  7A       Rx   d 8 10 50 01",
        "   4.0 1  7A       Rx   d 2 10 50 01",
        "   5.0 1  7A       Rx   d 3 10 5 001",
        "   6.0 1  7A       Rx   d -1 10",
        "   7.0 1  7A       Zx   d 1 10",
        "   8.0\t1  7A  rx  D  1  ff\r",
    ])
    got = {r.ts // 10**9: (r.len, r.data) for r in out.frames.collect()}
    assert got == {1: (8, "1A 2B 3C 4D 5E 6F 70 81"), 2: (64, long.upper()), 8: (1, "FF")}
    assert sorted(r.reason for r in out.rejects.collect()) == ["bad byte count", "bad direction"] + ["payload differs from byte count"] * 3

def test_file_scan_glob(spark, tmp_dir):
    for i in range(2):
        with open(os.path.join(tmp_dir, f"trace{i}.asc"), "w") as f:
            f.write("date Thu Dec 3\nbase hex  timestamps absolute\n")
            f.write(f"   {i}.000100 1  65       Rx   d 2 0A 0B\n")
    out = read_text_trace(spark, "file://" + os.path.join(tmp_dir, "*.asc"), order_by_ts=True)
    rows = out.frames.collect()
    assert [r.ts for r in rows] == [100000, 1000100000]
    assert out.rejects.count() == 0
