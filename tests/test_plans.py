"""Plan-shape guards for the optimisations the throughput depends on."""

from pyspark.sql import functions as F

from busframes import fixtures as fx
from busframes.operators.decode import decode_frames_array
from busframes.sources import SignalDictionary
from busframes.sources.text_trace import keep_frame_lines, parse_text_lines, split_parsed

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tokeniser_runs_once_per_line(spark):
    lines = spark.createDataFrame([("   0.000100 1  65       Rx   d 2 0A 0B",)], "value string")
    parsed = split_parsed(parse_text_lines(keep_frame_lines(lines)))
    for df in (parsed.frames, parsed.rejects):
        assert _plan(df).count("split(") == 1


def test_payload_word_computed_below_the_join(spark):
    d = SignalDictionary.load(fx.dictionary_rows(spark), persist=False)
    dec = decode_frames_array(fx.raw_frames(fx.lineitem(spark, SF)), d)
    plan = _plan(dec)
    assert " AS _word" in plan                       # a column, not inlined per signal
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_parquet_scan_is_pruned(spark):
    df = fx.raw_frames(fx.lineitem(spark, SF)).select("id")
    plan = _plan(df)
    assert "ReadSchema: struct<" in plan
    assert "l_extendedprice" not in plan and "l_shipdate" not in plan   # only the encoded columns are read


def test_filter_reaches_our_stored_tables(spark, tmp_dir):
    from busframes.operators.partition import write_partitioned
    from busframes.plans.views import read_message_table

    path = f"{tmp_dir}/msgs"
    d = SignalDictionary.load(fx.dictionary_rows(spark), persist=False)
    write_partitioned(decode_frames_array(fx.raw_frames(fx.lineitem(spark, SF)), d), path, ["botschaft"])
    plan = _plan(read_message_table(spark, path, 103, "MSG_103", ["orderkey"]).select("orderkey"))
    assert "PartitionFilters: [isnotnull(botschaft" in plan and "EqualTo(id,103)" in plan


def test_partitioned_write_runs_its_input_once(spark, tmp_dir):
    from busframes.operators.partition import write_partitioned

    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.range(0, 20_000, 1, 4).selectExpr("id % 3 as k", "id as ts").mapInArrow(count, "k long, ts long")
    write_partitioned(df, f"{tmp_dir}/once", ["k"])
    assert seen.value == 20_000 and spark.read.parquet(f"{tmp_dir}/once").count() == 20_000


def test_totals_and_cells_build_no_map(spark):
    """Rows by name come from the join with one row per signal: no map, no
    lambda, the payload word below the join."""
    from busframes.operators.decode import decode_text_long

    d = SignalDictionary.load(fx.dictionary_rows(spark), persist=False)
    lines = fx.text_trace_lines(spark, fx.raw_frames(fx.lineitem(spark, SF)))
    long = decode_text_long(split_parsed(parse_text_lines(lines)).frames, d)
    plan = _plan(long.groupBy("signal_name").agg(F.sum("value")))
    assert "map_from_arrays" not in plan and plan.count("BroadcastHashJoin") == 1
    decode = plan[:plan.index("BroadcastHashJoin")]
    assert "lambda" not in decode and "conv(" not in decode


def test_checks_of_a_line_run_once(spark):
    lines = spark.createDataFrame([("   0.000100 1  65       Rx   d 2 0A 0B",)], "value string")
    plan = _plan(split_parsed(parse_text_lines(keep_frame_lines(lines))).frames)
    assert plan.count("^[0-9A-Fa-f]{2}( [0-9A-Fa-f]{2})*$") == 1
