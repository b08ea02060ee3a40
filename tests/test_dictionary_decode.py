"""Dictionary aggregation, the join (broadcast and salted), decoders."""

from pyspark.sql import functions as F

import busframes.sources.dictionary as dictionary_module
from busframes.operators.decode import (
    decode_frames_array, decode_frames_long, decode_frames_map,
)
from busframes.sources.dictionary import SignalDictionary, aggregate_dictionary, read_dictionary

ROWS = [
    (0x7A, "MSG_A", "b", 8, 8), (0x7A, "MSG_A", "a", 0, 4), (0x7A, "MSG_A", "a", 4, 4),
    (0x7A, "MSG_B", "x", 0, 16),
    (0x7B, "MSG_C", "y", 60, 8),
]


def _dict(spark):
    return spark.createDataFrame(ROWS, "identifier int, botschaft string, signal_name string, startBit int, len int")


def test_aggregate_sorted_by_start_bit(spark):
    agg = {(r.identifier, r.botschaft): [(s.startBit, s.signal_name, s.len) for s in r.info]
           for r in aggregate_dictionary(_dict(spark)).collect()}
    assert agg[(0x7A, "MSG_A")] == [(0, "a", 4), (4, "a", 4), (8, "b", 8)]


def test_join_fans_out_and_drops_unknown(spark):
    d = SignalDictionary.load(_dict(spark))
    frames = spark.createDataFrame([(1, 5, 0x7A, [0x21, 0x43, 0x65]), (1, 6, 0x99, [1]), (1, 7, 0x7B, [1] * 8)],
                                   "module smallint, ts bigint, id int, data array<int>")
    out = {r.botschaft: list(r.vals) for r in decode_frames_array(frames, d).collect()}
    assert out == {"MSG_A": [1, 2, 0x43], "MSG_B": [0x4321], "MSG_C": [None]}


def test_map_form_last_wins_and_long_form(spark):
    d = SignalDictionary.load(_dict(spark))
    frames = spark.createDataFrame([(1, 5, 0x7A, "21 43 65")],
                                   "module smallint, ts bigint, id int, data string")
    maps = {r.botschaft: dict(r.map) for r in decode_frames_map(frames, d).collect()}
    assert maps == {"MSG_A": {"a": 2, "b": 0x43}, "MSG_B": {"x": 0x4321}}
    raw = spark.createDataFrame([(1, 5, 0x7A, [0x21, 0x43, 0x65])],
                                "module smallint, ts bigint, id int, data array<int>")
    long = sorted((r.botschaft, r.pos, r.signal_name, r.value) for r in decode_frames_long(raw, d).collect())
    assert long == [("MSG_A", 0, "a", 1), ("MSG_A", 1, "a", 2), ("MSG_A", 2, "b", 0x43), ("MSG_B", 0, "x", 0x4321)]


def test_salted_join_equals_broadcast(spark, monkeypatch):
    frames = spark.createDataFrame([(1, t, 0x7A, [t % 256, 1, 2]) for t in range(500)],
                                   "module smallint, ts bigint, id int, data array<int>")
    d = SignalDictionary.load(_dict(spark))
    expect = sorted(tuple(r) for r in decode_frames_long(frames, d).collect())
    monkeypatch.setattr(dictionary_module, "MAX_BROADCAST_BYTES", 1)
    d2 = SignalDictionary.load(_dict(spark))
    assert not d2.broadcastable
    plan_df = decode_frames_long(frames, d2)
    assert sorted(tuple(r) for r in plan_df.collect()) == expect


def test_message_lookups(spark):
    d = SignalDictionary.load(_dict(spark))
    assert {r.identifier: r.botschaft for r in d.message_by_identifier().collect()} == {0x7A: "MSG_A", 0x7B: "MSG_C"}
    lists = {(i, b): names for i, b, names in d.layouts()}
    assert lists[0x7A, "MSG_A"] == ["a", "a", "b"] and lists[0x7B, "MSG_C"] == ["y"]


def test_one_message_name_under_two_ids(spark):
    from busframes.operators.shape import values_in_order

    rows = [(1, "M", "a", 0, 8), (1, "M", "b", 8, 8), (2, "M", "c", 0, 8), (2, "M", "d", 8, 8), (2, "M", "e", 16, 8)]
    d = SignalDictionary.load(spark.createDataFrame(rows, "identifier int, botschaft string, signal_name string, startBit int, len int"))
    frames = spark.createDataFrame([(0, 1, "01 02 03"), (1, 2, "01 02 03")], "ts bigint, id int, data string")
    dec = decode_frames_map(frames, d, with_names=True).select("id", "names", values_in_order("map", "names").alias("vals"))
    assert {r.id: (list(r.names), list(r.vals)) for r in dec.collect()} == {1: (["a", "b"], [1, 2]), 2: (["c", "d", "e"], [1, 2, 3])}


def test_view_names_never_collide():
    from busframes.plans.views import view_names

    layouts = [(1, "A-B", []), (2, "A_B", []), (3, "a b", []), (4, "C", []), (5, "C", []), (9, "A_B_1", []), (6, "D", [])]
    names = view_names(layouts)
    assert len({v.lower() for v in names.values()}) == len(layouts) and names[6, "D"] == "msg_D" and names[4, "C"] == "msg_C_4"

def test_read_dictionary_csv_casts(spark, tmp_dir):
    path = f"{tmp_dir}/dbc"
    _dict(spark).select(F.col("identifier").cast("string").alias("identifier"), "botschaft", "signal_name",
                        "startBit", "len", F.lit("unused").alias("comment")) \
        .write.option("header", "true").csv(path)
    df = read_dictionary(spark, path, fmt="csv")
    assert dict(df.dtypes) == {"identifier": "int", "botschaft": "string", "signal_name": "string",
                               "startBit": "int", "len": "int"}
    assert df.count() == len(ROWS)


def test_filter_on_id_reaches_both_sides(spark):
    d = SignalDictionary.load(_dict(spark), persist=False)
    frames = spark.createDataFrame([(1, 5, 0x7A, [1, 2, 3])], "module smallint, ts bigint, id int, data array<int>")
    plan = decode_frames_array(frames.filter(F.col("id") == 0x7A), d)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("= 122)") >= 2  # frames side and dictionary side


def test_salted_join_spreads_a_hot_id(spark, monkeypatch):
    from busframes.operators.decode import join_dictionary

    monkeypatch.setattr(dictionary_module, "MAX_BROADCAST_BYTES", 1)
    d = SignalDictionary.load(_dict(spark))
    rows = [(1, t, 0x7A if t % 5 < 3 else 0x7B, [t % 256, 1]) for t in range(20000)]   # 60% one id
    frames = spark.createDataFrame(rows, "module smallint, ts bigint, id int, data array<int>")
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.skewJoin.enabled": "false",        # only the salting acts
            "spark.sql.autoBroadcastJoinThreshold": "-1",          # a dictionary too big to broadcast
            "spark.sql.shuffle.partitions": "32"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        joined = join_dictionary(frames, d)
        sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p"))
                 .agg(F.count(F.lit(1)).alias("n")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    total = sum(sizes)
    assert total == 12000 * 2 + 8000          # 0x7A fans out to two messages
    assert max(sizes) < 0.15 * total           # no task holds the hot id alone


def test_text_forms_agree(spark):
    """Long, array, wide and map forms of one table, with a repeated name, a
    signal beyond the payload and an FD payload; broadcast or salted."""
    from dataclasses import replace

    from busframes.operators.decode import decode_text_array, decode_text_long
    from busframes.operators.shape import wide_from_names
    from busframes.sources import dictionary as D

    rows = [(1, "A", "x", 0, 8), (1, "A", "y", 8, 16), (1, "A", "x", 40, 4), (1, "B", "far", 100, 12), (2, "C", "z", 0, 64)]
    d = SignalDictionary.load(spark.createDataFrame(rows, "identifier int, botschaft string, signal_name string, startBit int, len int"), persist=False)
    frames = spark.createDataFrame([(1, 10, "01 02 03 04 05 F6 07 08"), (1, 20, " ".join(f"{i:02X}" for i in range(16))), (2, 30, "FF FF FF FF FF FF FF FF"),
                                    (2, 40, "01"), (9, 50, "01")], "id int, ts long, data string")
    want = None
    for limit in (D.MAX_BROADCAST_BYTES, 0):
        sized = replace(d, n_bytes=d.n_bytes if limit else limit + D.MAX_BROADCAST_BYTES + 1, n_signal_bytes=d.n_signal_bytes if limit else D.MAX_BROADCAST_BYTES + 1)
        long = {(r.ts, r.botschaft, r.signal_name): r.value for r in decode_text_long(frames, sized).collect()}
        array = {(r.ts, r.botschaft, n): v for r in decode_text_array(frames, sized, with_names=True).collect() for n, v in zip(r.names, r.vals)}
        maps = {(r.ts, r.botschaft, n): v for r in decode_frames_map(frames, sized).collect() for n, v in r.map.items()}
        assert long == array == maps and (want is None or long == want)
        want = long
    assert want[10, "A", "x"] == 6 and want[10, "A", "y"] == 0x0302 and want[10, "B", "far"] is None and want[20, "B", "far"] == (0x0D0C >> 4) & 0xFFF
    assert want[30, "C", "z"] == -1 and want[40, "C", "z"] is None
    wide = {(r.ts, r.botschaft): (r.x, r.far) for r in wide_from_names(decode_text_array(frames, d, with_names=True), ["x", "far"], keep=("ts", "botschaft")).collect()}
    assert wide[10, "A"] == (6, None) and wide[20, "B"][0] is None


def test_long_payloads_are_decoded_from_their_digits(spark):
    """signals anywhere in payloads of 1 to 70 bytes, in layouts that are
    written out and in larger ones; no byte of a payload becomes a token."""
    import random

    from busframes.operators.decode import decode_text_array, decode_text_long

    rng = random.Random(7)
    layouts = {1: [("a", 56, 64), ("b", 63, 17), ("c", 3, 64), ("d", 0, 0)],
               2: [(f"s{k}", rng.randrange(0, 560), rng.randrange(1, 65)) for k in range(20)]}
    frames = [(t, 1 + t % 2, " ".join(f"{rng.randrange(256):02X}" for _ in range(rng.choice((1, 7, 8, 9, 16, 17, 64, 70))))) for t in range(120)]
    df = spark.createDataFrame([*frames, (500, 1, None)], "ts bigint, id int, data string")

    def value(text, start, length):
        data = bytes.fromhex(text)
        if not 1 <= length <= 64 or start + length > 8 * len(data):
            return None
        v = int.from_bytes(data, "little") >> start & (1 << length) - 1
        return v - 2**64 if v >= 2**63 else v

    want = {(t, n): value(text, s, l) for t, i, text in frames for n, s, l in layouts[i]}
    want |= {(500, n): None for n, _, _ in layouts[1]}
    for ids in ((1,), (1, 2)):
        rows = [(i, f"M{i}", n, s, l) for i in ids for n, s, l in layouts[i]]
        d = SignalDictionary.load(spark.createDataFrame(rows, "identifier int, botschaft string, signal_name string, startBit int, len int"), persist=False)
        assert d.most_signals == (4 if ids == (1,) else 20)
        arrays, long = decode_text_array(df, d, with_names=True), decode_text_long(df, d)
        here = {k: v for k, v in want.items() if k[0] == 500 or 1 + k[0] % 2 in ids}
        assert {(r.ts, n): v for r in arrays.collect() for n, v in zip(r.names, r.vals, strict=True)} == here
        assert {(r.ts, r.signal_name): r.value for r in long.collect()} == here
        assert "split(trim(data" not in arrays._jdf.queryExecution().toString()


def test_small_layouts_are_not_interpreted(spark):
    """F8: values of classic frames in small layouts stand in the plan one by
    one; the lambda that is left is for payloads over 8 bytes."""
    from busframes import fixtures as fx
    from busframes.operators.decode import decode_frames_array

    d = SignalDictionary.load(fx.dictionary_rows(spark), persist=False)
    df = spark.createDataFrame([(1, 101, [1, 2, 3, 4, 5, 6, 7, 8]), (2, 101, [255])], "ts bigint, id int, data array<int>")
    dec = decode_frames_array(df, d)
    assert "THEN transform(info" in (plan := dec._jdf.queryExecution().executedPlan().toString()) and "ELSE slice(array(" in plan
    got = {(r.ts, r.botschaft): list(r.vals) for r in dec.collect()}
    assert got[1, "MSG_ALT"] == [0x201] and got[2, "MSG_ALT"] == [None]
    assert got[1, "MSG_101"] == [0x201, 0x403, 0x60504030201 >> 20 & 0xFFFFF, 0, 7] and got[2, "MSG_101"] == [None] * 5
