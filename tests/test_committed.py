"""Committed delivery: retried tasks, repeated and failed jobs, recovery."""

import glob
import json
import os
import subprocess
import sys
import tempfile
import textwrap

import pytest
from pyspark.sql import functions as F

from busframes.sinks.committed import RecordingStore, deliver_committed

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _stored(root):
    return [json.loads(line) for p in sorted(glob.glob(f"{root}/*.jsonl")) for line in open(p)]


def test_rows_arrive_in_batches_once(spark, tmp_dir):
    df = spark.range(0, 1000, 1, 3).withColumn("x", F.lit(None).cast("string"))
    assert deliver_committed(df, lambda: RecordingStore(tmp_dir), 150, "first") == 1000
    rows = _stored(tmp_dir)
    assert sorted(r["id"] for r in rows) == list(range(1000)) and rows[0]["x"] is None
    sizes = [len(open(p).readlines()) for p in glob.glob(f"{tmp_dir}/*.jsonl")]
    assert len(sizes) == 9 and sorted(sizes)[-6:] == [150] * 6
    # the same job again sends nothing, another one does
    assert deliver_committed(spark.range(5), lambda: RecordingStore(tmp_dir), 150, "first") == 1000
    assert len(_stored(tmp_dir)) == 1000
    assert deliver_committed(spark.range(5), lambda: RecordingStore(tmp_dir), 150, "second") == 5
    assert len(_stored(tmp_dir)) == 1005 and not os.listdir(f"{tmp_dir}/_staged")
    assert spark.read.json(tmp_dir).count() == 1005  # a plain reader sees the published files alone


def test_empty_tables(spark, tmp_dir):
    assert deliver_committed(spark.range(0), lambda: RecordingStore(tmp_dir), 10, "none") == 0
    assert RecordingStore(tmp_dir).published("none") == 0 and _stored(tmp_dir) == []


def test_a_failed_job_leaves_nothing(spark, tmp_dir):
    class Broken(RecordingStore):
        def send(self, rows):
            super().send(rows)
            if any(r["id"] == 777 for r in rows):
                raise OSError("store is gone")

    with pytest.raises(Exception, match="store is gone"):
        deliver_committed(spark.range(0, 1000, 1, 4), lambda: Broken(tmp_dir), 50, "job")
    assert _stored(tmp_dir) == [] and RecordingStore(tmp_dir).published("job") is None
    assert deliver_committed(spark.range(0, 1000, 1, 4), lambda: RecordingStore(tmp_dir), 50, "job") == 1000
    assert sorted(r["id"] for r in _stored(tmp_dir)) == list(range(1000)) and not os.listdir(f"{tmp_dir}/_staged")


def test_a_driver_lost_while_publishing(tmp_dir):
    class Dying(RecordingStore):
        def recover(self, job):
            pass  # dies after the decision

    store = Dying(tmp_dir)
    stages = []
    for k in range(3):
        store.begin("job")
        store.send([{"k": k}])
        stages.append(store.prepare())
    store.begin("job")
    store.send([{"k": "an attempt that doesn't count"}])
    store.publish("job", stages, 3)
    assert _stored(tmp_dir) == [] and store.published("job") == 3
    RecordingStore(tmp_dir).recover("job")
    RecordingStore(tmp_dir).recover("job")
    assert sorted(r["k"] for r in _stored(tmp_dir)) == [0, 1, 2]


RETRIED = textwrap.dedent("""
    import sys
    repo, plain, committed = sys.argv[1:]
    sys.path.insert(0, repo)
    from pyspark import TaskContext
    from busframes.session import build_session
    from busframes.sinks.committed import RecordingStore, deliver_committed
    from busframes.sinks.delivery import RecordingClient, deliver

    spark = build_session("local[2,4]", 4)  # a task may fail three times

    def fails_once(base):
        class Client(base):
            sent = 0
            def send(self, rows):
                super().send(rows)
                self.sent += 1
                if self.sent == 2 and TaskContext.get().attemptNumber() == 0:
                    raise OSError("connection lost")
        return Client

    df = spark.range(0, 3000, 1, 3)
    deliver(df, lambda: fails_once(RecordingClient)(plain), 100)
    assert deliver_committed(df, lambda: fails_once(RecordingStore)(committed), 100, "job") == 3000
    print("done")
""")


def test_a_task_that_fails_half_way_and_runs_again():
    """Without commits the first attempt's batches stay (the store holds rows
    twice); with them each row is there once."""
    plain, committed = tempfile.mkdtemp(), tempfile.mkdtemp()
    run = subprocess.run([sys.executable, "-c", RETRIED, REPO, plain, committed], capture_output=True, text=True, timeout=300,
                         env=os.environ | {"PYSPARK_PYTHON": sys.executable})
    assert "done" in run.stdout, run.stderr[-2000:]
    assert len(_stored(plain)) == 3000 + 3 * 200
    rows = [r["id"] for r in _stored(committed)]
    assert sorted(rows) == list(range(3000)) and not os.listdir(f"{committed}/_staged")


def test_jobs_deliver_once(spark, tmp_dir):
    from busframes import fixtures as fx
    from busframes.plans.jobs import JOBS, Target, run
    from busframes.sources import SignalDictionary

    src, out = f"{tmp_dir}/bin", f"{tmp_dir}/points"
    fx.write_blobs(fx.binary_blobs(fx.raw_frames(fx.lineitem(spark, "/root/testdata/sf0.001"), with_file_key=True)), src)
    d = SignalDictionary.load(fx.dictionary_rows(spark))
    target = Target(path=out, delivery="day-1")
    first = run(spark, JOBS["HexToInflux_2"], src, d, target).metrics["delivered"]
    again = run(spark, JOBS["HexToInflux_2"], src, d, target).metrics["delivered"]
    assert first == again == len(_stored(out)) > 0


def test_write_by_key_runs_its_input_once(spark):
    from busframes.sinks.delivery import write_by_key

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 6000, 1, 4).selectExpr("cast(nullif(id % 4, 3) as smallint) as module", "id as ts").mapInArrow(count, "module smallint, ts long")
    got = {}
    write_by_key(df, "module", lambda rows, k: got.update({k: (rows.columns, sorted(r.ts for r in rows.collect()))}))
    assert seen.value == 6000
    assert got == {k: (["ts"], [i for i in range(6000) if i % 4 == (3 if k is None else k)]) for k in (0, 1, 2, None)}


def test_rows_of_a_batch_by_columns():
    """Values and text as row by row, in a fraction of the time."""
    import json
    import time
    from decimal import Decimal

    import pyarrow as pa
    from busframes.sinks.committed import _encode, _rows

    t = pa.schema([("s", pa.string()), ("n", pa.int64()), ("d", pa.decimal128(20, 0)), ("names", pa.list_(pa.string())),
                   ("vals", pa.list_(pa.decimal128(20, 0))), ("ts", pa.timestamp("us", "UTC"))])
    odd = [{"s": None, "n": None, "d": None, "names": None, "vals": [], "ts": None},
           {"s": "a\"ä", "n": -1, "d": Decimal(2**63), "names": ["x", None], "vals": [None, Decimal(7)], "ts": 5}]
    for rows in (odd, odd[1:], []):
        batch = pa.RecordBatch.from_pylist(rows * 3, t)
        for b in (batch, batch.slice(1)):
            assert _rows(b) == b.to_pylist()
            assert [_encode(r) for r in _rows(b)] == [json.dumps(r, default=str) for r in b.to_pylist()]
    many = pa.RecordBatch.from_pylist([{**odd[1], "names": list("abcde"), "vals": list(map(Decimal, range(5)))}] * 20_000, t)
    begun = time.process_time()
    plain = many.to_pylist()
    between = time.process_time()
    assert _rows(many) == plain and time.process_time() - between < 0.8 * (between - begun) + 0.2
