"""Time order by the index against a sort of all frames."""

import os
import random

import pytest
from pyspark.sql import functions as F
from test_recordings_format import _record

from busframes.sources.time_index import INDEX_SCHEMA, build_time_index, read_indexed
from busframes.sources.time_order import ORDER, dealt_chunks, time_cuts, time_ordered


def _recordings(folder, kind):
    """forward: six recordings, the last two at the same time; backward: the
    records of each recording in any order; tied: one time for all."""
    rng = random.Random(kind)
    os.makedirs(folder)
    for k in range(6):
        sec, rows = 1000 * min(k, 4) - 1500, []
        for _ in range(6000):
            sec += rng.random() < 0.1
            at = (5, 0) if kind == "tied" else (sec, rng.randrange(10**9))
            rows.append(_record(*at, rng.randrange(-1, 3), rng.choice([7, 101, -5]), [rng.randrange(256)] * rng.choice([0, 3, 8, 64])))
        if kind == "backward":
            rng.shuffle(rows)
        with open(f"{folder}/{k}.bin", "wb") as f:
            f.write(b"".join(rows) + (rows[0][:-1] if k == 2 else b""))
    open(f"{folder}/nothing.bin", "wb").close()
    return folder


@pytest.mark.parametrize("kind", ["forward", "backward", "tied"])
@pytest.mark.parametrize("most_reads", [0.0, 3.0, 1e9])
def test_partitions_are_in_time_order(spark, tmp_path, kind, most_reads):
    index = build_time_index(spark, _recordings(f"{tmp_path}/rec", kind), chunk_bytes=1 << 16).persist()
    got = time_ordered(index, 3000, most_reads)
    parts = got.select("module", "ts", "id", "cs", "data", F.spark_partition_id().alias("p")).collect()  # partition by partition
    rows = [tuple(r)[:5] for r in parts]
    key = [(r.ts, r.id, r.module, r.data) for r in parts]
    assert key == sorted(key) and [r.p for r in parts] == sorted(r.p for r in parts)
    want = read_indexed(index).frames.select("module", "ts", "id", "cs", "data").collect()
    assert sorted(rows) == sorted(map(tuple, want)) and len(rows) == 36_000
    if kind != "tied":
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) >= 8 and max(sizes) < 9000


def test_frames_do_not_move(spark, tmp_path):
    """Only descriptions of chunks are dealt, nearly every chunk to one task."""
    index = build_time_index(spark, _recordings(f"{tmp_path}/rec", "forward"), chunk_bytes=1 << 16).persist()
    plan = time_ordered(index, 3000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("MapInArrow") < plan.index("Exchange")
    cuts = time_cuts(index, 3000)
    assert cuts == sorted(set(cuts)) and 8 <= len(cuts) <= 12
    assert dealt_chunks(index, cuts).count() <= index.filter("n > 0").count() + 2 * len(cuts)


def test_nothing_recorded(spark):
    assert time_ordered(spark.createDataFrame([], INDEX_SCHEMA)).collect() == [] and set(ORDER) <= set(time_ordered(spark.createDataFrame([], INDEX_SCHEMA)).columns)
