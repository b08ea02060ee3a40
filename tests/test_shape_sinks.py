"""Replay, reshaping, batching and sink shaping."""

import glob
import os
import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from busframes.operators.batching import rank_within_key
from busframes.operators.shape import (
    map_to_cells, replay, sorted_cells, strings_map, values_in_order, wide_from_array, wide_to_cells,
)
from busframes.sinks.delivery import RecordingClient, deliver
from busframes.sinks.shaping import insert_statements, line_protocol, unsigned_decimal, wide_store_rows


def test_replay_eleven_days(spark):
    df = spark.createDataFrame([(1, 5, 0x7A, [1])], "module smallint, ts bigint, id int, data array<int>")
    ts = sorted(r.ts for r in replay(df).collect())
    assert len(ts) == 11 and ts[0] == 5 + 199 * 86_400_000_000
    assert all(b - a == 86_400_000_000 for a, b in zip(ts, ts[1:]))


def test_rank_within_key_skewed(spark):
    rows = [("hot" if i % 3 else f"k{i % 7}", i % 50, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "k string, ts int, i int")
    r = rank_within_key(df, ["k"], ["ts", "i"], partitions=16).withColumn(
        "ref", F.row_number().over(Window.partitionBy("k").orderBy("ts", "i")) - 1)
    assert r.filter(F.col("rank") != F.col("ref")).count() == 0


def _decoded(spark):
    return spark.createDataFrame(
        [(2, 0x7A, "MSG_A", ["b", "a"], [5, None]), (1, 0x7A, "MSG_A", ["b", "a"], [3, 4]),
         (3, 0x7A, "MSG_A", ["b", "a"], [6, 7]), (1, 0, "MSG_Z", ["z"], [-1])],
        "ts bigint, id int, botschaft string, names array<string>, vals array<bigint>")


def test_insert_statements(spark):
    out = {(r.botschaft, r.batch): (r.n_rows, r.statement)
           for r in insert_statements(_decoded(spark), batch_rows=2).collect()}
    assert out[("MSG_A", 0)] == (2, 'INSERT INTO Datalogger1_MSG_A USING MSG_A TAGS (2,"Datalogger1") '
                                    "VALUES (1,3,4) (2,5,NULL)")
    assert out[("MSG_A", 1)][0] == 1 and out[("MSG_Z", 0)][1].endswith("VALUES (1,-1)")


def test_line_protocol_and_rows(spark):
    lines = {r.time: r.line for r in line_protocol(_decoded(spark)).collect() if r.measurement == "MSG_A"}
    assert lines[1] == "MSG_A,device=Datalogger1 a=4i,b=3i 1"
    assert lines[2] == "MSG_A,device=Datalogger1 b=5i 2"
    rows = wide_store_rows(_decoded(spark)).filter("table_name = 'MSG_Z'").first()
    assert int(rows.vals[0]) == 2**64 - 1 and rows.deviceid == "Datalogger1"
    assert str(rows.ts) == "1970-01-01 00:00:00"


def test_unsigned_decimal(spark):
    r = spark.range(1).select(unsigned_decimal(F.lit(-2).cast("bigint")).alias("u")).first()
    assert int(r.u) == 2**64 - 2


def test_cells_and_maps(spark):
    dec = _decoded(spark).withColumn("map", F.map_from_arrays("names", "vals")).withColumn(
        "rk", F.concat("botschaft", F.lit(":"), F.col("ts").cast("string")))
    cells = sorted_cells(map_to_cells(dec, "rk", "f")).collect()
    assert [(c.row_key, c.qualifier, c.value) for c in cells][:2] == [("MSG_A:1", "a", "4"), ("MSG_A:1", "b", "3")]
    wide = wide_from_array(_decoded(spark).filter("botschaft='MSG_A'"), ["b", "a"], keep=("ts",))
    wc = wide_to_cells(wide.withColumn("rk", F.col("ts").cast("string")).drop("ts"), "rk", "f").collect()
    assert sorted({c.qualifier for c in wc}) == ["a", "b"]
    ordered = dec.select(values_in_order("map", F.array(F.lit("a"), F.lit("b"))).alias("v")).collect()
    assert [list(r.v) for r in ordered][1] == [4, 3]
    m = dec.select(strings_map(dec, ["ts", "vals"]).alias("m")).first().m
    assert m["ts"] == "2"


def test_deliver_recording_client(spark, tmp_dir):
    df = _decoded(spark).repartition(3)
    root = f"{tmp_dir}/sink"
    assert deliver(df, lambda: RecordingClient(root), batch_rows=1) == 4
    files = glob.glob(f"{root}/*.jsonl")
    rows = [json.loads(line) for p in files for line in open(p)]
    assert sorted(r["ts"] for r in rows) == [1, 1, 2, 3] and len(files) == 4
    root2 = f"{tmp_dir}/sink2"
    assert deliver(df.coalesce(1), lambda: RecordingClient(root2), batch_rows=3) == 4
    assert sorted(len(open(p).readlines()) for p in glob.glob(f"{root2}/*.jsonl")) == [1, 3]


def test_partition_helpers(spark, tmp_dir):
    from busframes.operators.partition import (
        cluster_by_id, ensure_parallelism, persist, range_by_id_ts, write_partitioned,
    )

    rows = [(i % 3, i, "hot" if i % 4 else "cold") for i in range(400)]
    df = spark.createDataFrame(rows, "id int, ts bigint, msg string").coalesce(1)
    assert ensure_parallelism(df, 4).rdd.getNumPartitions() == 4
    assert ensure_parallelism(df.repartition(6), 4).rdd.getNumPartitions() == 6
    # Runs of one id per partition, (id, ts) order inside
    for part in cluster_by_id(df, 2).rdd.glom().collect():
        keys = [(r.id, r.ts) for r in part]
        assert keys == sorted(keys)
    parts = range_by_id_ts(df, 4).rdd.glom().collect()
    assert sum(len(p) for p in parts) == 400
    # A hot key is written by several tasks, read back whole
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "16k")  # small input
    try:
        many = spark.range(40_000).selectExpr("id % 3 as id", "id as ts", "if(id % 4 > 0, 'hot', 'cold') as msg")
        write_partitioned(many.repartition(4), f"{tmp_dir}/w", ["msg"])
    finally:
        spark.conf.unset(size)
    back = spark.read.parquet(f"{tmp_dir}/w")
    assert back.count() == 40_000 and back.filter("msg = 'hot'").count() == 30_000
    hot_files = [f for f in os.listdir(f"{tmp_dir}/w/msg=hot") if f.endswith(".parquet")]
    assert len(hot_files) >= 2
    # C1
    cached = persist(df)
    assert cached.count() == 400 and cached.is_cached
    cached.unpersist()


def test_rank_within_key_sampled_ranges(spark):
    # large enough that the range partitioner samples instead of taking all rows
    df = (spark.range(300_000)
          .select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("k"),
                  (F.col("id") * 7919 % 100_003).alias("ts"), F.col("id").alias("i")))
    r = rank_within_key(df, ["k"], ["ts", "i"], partitions=32)
    ref = df.withColumn("ref", F.row_number().over(Window.partitionBy("k").orderBy("ts", "i")) - 1)
    joined = r.join(ref, ["k", "ts", "i"])
    assert joined.count() == 300_000
    assert joined.filter(F.col("rank") != F.col("ref")).count() == 0


def test_rank_within_key_ties_nulls_and_no_single_partition(spark):
    df = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate([(None, 5), ("a", None), ("a", 5), ("a", 5), ("b", -3)] * 300)], "k string, ts long, i long")
    for parts in (None, 40):
        r = rank_within_key(df.repartition(3), ["k"], ["ts", "i"], partitions=parts)
        ref = Window.partitionBy("k").orderBy("ts", "i")
        assert r.columns == ["k", "ts", "i", "rank"] and r.dtypes[-1][1] == "bigint"
        assert r.withColumn("ref", F.row_number().over(ref) - 1).filter("rank <> ref").count() == 0 and r.count() == 1500
        assert "SinglePartition" not in r._jdf.queryExecution().executedPlan().toString()
    assert rank_within_key(df.limit(0), ["k"], ["ts", "i"]).count() == 0


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    import pytest

    from busframes.session import checkpoint_base

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_base(SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context))


def test_checkpoint_base_reads_session(spark):
    from busframes.session import checkpoint_base, shared_dir

    base = checkpoint_base(spark)
    assert base and spark.sparkContext.getCheckpointDir()
    p = shared_dir(spark, "x")
    assert p.startswith(base + "/x-")


def test_write_jdbc_by_key_splits_tables(spark, monkeypatch):
    import busframes.sinks.delivery as delivery

    written = {}

    def fake_write_jdbc(df, url, table, options=None, batch_rows=10_000, mode="append"):
        written[table] = (url, batch_rows, sorted(tuple(r) for r in df.collect()), df.columns)

    monkeypatch.setattr(delivery, "write_jdbc", fake_write_jdbc)
    df = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (1, 30, "c"), (None, 40, "d")],
                               "module smallint, ts bigint, data string")
    keys = delivery.write_jdbc_by_key(df, "module", "jdbc:none://x", lambda m: f"datalogger_1_can{m}",
                                      batch_rows=500)
    assert sorted(keys, key=str) == sorted([1, 2, None], key=str)
    assert written["datalogger_1_can1"][2] == [(10, "a"), (30, "c")]
    assert written["datalogger_1_can2"][2] == [(20, "b")]
    assert written["datalogger_1_canNone"][2] == [(40, "d")]      # null-safe match
    assert all(v[0] == "jdbc:none://x" and v[1] == 500 and v[3] == ["ts", "data"] for v in written.values())


def test_region_files_hold_one_region(spark, tmp_dir):
    import pyarrow.parquet as pq

    from busframes.sinks.shaping import write_region_cells

    rows = [(f"k{i % 997:03d}", "f", f"q{i % 5}", str(i)) for i in range(6000)]
    cells = spark.createDataFrame(rows, "row_key string, family string, qualifier string, value string").repartition(5)
    borders = ["k100", "k5", "k0995"]  # in any order
    write_region_cells(cells, borders, f"{tmp_dir}/cells")
    seen = 0
    for region in range(4):
        for f in glob.glob(f"{tmp_dir}/cells/region={region}/*.parquet"):
            got = [(r["row_key"], r["qualifier"]) for r in pq.ParquetFile(f).read().to_pylist()]
            assert got == sorted(got) and all(sum(b <= k for b in borders) == region for k, _ in got)
            seen += len(got)
    assert seen == 6000


def test_buckets_need_no_exchange(spark, tmp_dir):
    from busframes.operators.buckets import drop_bucketed, join_by_id, totals_by_id, write_bucketed

    frames = spark.range(0, 9000, 1, 4).selectExpr("cast(if(id % 3 = 0, 7, id % 11) as int) as id", "id as ts", "id % 2 as x")
    side = spark.createDataFrame([(7, "a"), (7, "b"), (3, "c")], "id int, name string")
    want_totals = sorted(tuple(r) for r in frames.groupBy("id").agg(F.count("*"), F.max("ts")).collect())
    want_join = sorted(tuple(r) for r in frames.join(side, "id").groupBy("id", "name").count().collect())
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for slices in (1, 4):
            table = f"bucket_test_{slices}"
            stored = write_bucketed(frames, table, f"{tmp_dir}/b{slices}", 6, slices)
            totals = totals_by_id(stored, ("n", F.count("*"), "sum"), ("last", F.max("ts"), "max"))
            assert sorted(tuple(r) for r in totals.collect()) == want_totals
            joined = join_by_id(stored, side, slices)
            assert sorted(tuple(r) for r in joined.groupBy("id", "name").count().collect()) == want_join
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert plan.count("Exchange") == 1  # of the small side
            groups = stored.groupBy("id", "slice").count()._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in groups and "Bucketed: true" in groups
            if slices > 1:  # the hot id lies in several buckets
                files = stored.filter("id = 7").select(F.input_file_name().alias("f")).distinct().count()
                assert files >= 2
            drop_bucketed(spark, table)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_global_order_cuts_grow_with_the_rows(spark, monkeypatch):
    """A hot id is dealt to several tasks, and files hold bounded runs."""
    from pyspark.sql import functions as F
    from busframes.operators.partition import cluster_by_id
    from busframes.plans import catalog

    df = spark.range(4000).select(F.lit(7).alias("id"), F.pmod("id", F.lit(977)).alias("ts"))
    parts = [[(r.id, r.ts) for r in p] for p in cluster_by_id(df, 8, slices=16).rdd.glom().collect()]
    assert all(p == sorted(p) for p in parts) and max(map(len, parts)) < 2000
    seen, ranged = [], catalog.range_by_id_ts
    monkeypatch.setattr(catalog, "TASK_ROWS", 500)
    monkeypatch.setattr(catalog, "range_by_id_ts", lambda df, n: seen.append(n) or ranged(df, n))
    sf = "/root/testdata/sf0.001"
    rows = catalog.q_global_order(spark, sf).collect()
    n = spark.read.parquet(f"{sf}/lineitem.parquet").count()
    assert seen == [-(-n // 500)] and seen[0] > 6
    assert sum(r.n for r in rows) == n and not any(r.out_of_order for r in rows)


def test_points_of_few_fields_are_not_interpreted(spark):
    """F8: with a known bound the fields are written out; the lines stay."""
    rows = [(1, "M x", ["b c", "a", "z"], [5, None, -1]), (2, "M x", ["b", "b"], [7, 3]), (3, "N", ["a"], [None]), (4, "N", [], []), (5, "N", ["k=,"], [0])]
    df = spark.createDataFrame(rows, "ts bigint, botschaft string, names array<string>, vals array<bigint>")
    want = {1: "M\\ x,device=d\\ 1 b\\ c=5i,z=-1i 1", 2: "M\\ x,device=d\\ 1 b=3i,b=7i 2", 5: "N,device=d\\ 1 k\\=\\,=0i 5"}
    for most in (0, 3, 100):
        points = line_protocol(df, "d 1", most)
        assert {r.time: r.line for r in points.collect()} == want
        assert ("lambda" in points._jdf.queryExecution().executedPlan().toString()) == (most != 3)


def test_sketches_of_a_key_are_merged_by_several_tasks(spark):
    """shares of very different size give cuts at the right ranks."""
    from busframes.operators.batching import KEY_CUTS, MERGERS, _key_stats

    df = (spark.range(0, 90_000, 1, 1).union(spark.range(90_000, 100_000, 1, 3)).union(spark.range(100_000, 100_010, 1, 7))
          .select(F.lit("hot").alias("k"), (F.col("id") * 7 % 100_010).alias("v"))
          .union(spark.createDataFrame([("one", 5), ("none", None), (None, 1)], "k string, v bigint")))
    stats = _key_stats(df, ["k"], F.col("v"))
    assert f"pmod(SPARK_PARTITION_ID(), {MERGERS})" in stats._jdf.queryExecution().toString().replace("_nondeterministic", "")
    got = {r.k: r for r in stats.collect()}
    hot = got["hot"]
    assert hot["_rows"] == 100_010 and len(hot["_all"]) == KEY_CUTS and hot["_all"] == sorted(hot["_all"])
    assert all(abs(hot["_all"][i * 512 - 1] - 100_010 * i / 16) < 1000 for i in range(1, 16))
    assert got["one"]["_rows"] == 1 and set(got["one"]["_all"]) == {5} and got["none"]["_rows"] == 1 and not got["none"]["_all"]
    assert got[None]["_rows"] == 1
