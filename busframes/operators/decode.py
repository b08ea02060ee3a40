"""Frames x dictionary -> decoded signals.

The dictionary side is small and measured (``SignalDictionary``): it is
broadcast when its size in bytes is under the bound, so the frames are never
shuffled for the join. Above the bound the join is a shuffle join whose
frame side is salted, so a single hot id cannot land in one task.
Decoding is a native expression (no Python UDF).

The long form joins the frames with one row per signal: the join itself yields
the (frame, signal) rows, and each value is a shift and a mask of the frame's
payload word, all inside whole-stage codegen. Values that end up as rows,
columns or positional arrays never pass through a map; a map is built only
where a map is the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from busframes.functions.bits import (
    decode_layout, extract_bits, extract_hex_bits, hex_bytes, hex_digits, hex_digits_word, idiv, payload_word,
)
from busframes.sources.dictionary import SignalDictionary

JOIN_SALTS = 32  # at least; a quarter of the shuffle partitions if that is more


def _join(frames: DataFrame, side: DataFrame, small: bool) -> DataFrame:
    """frames.id = side.identifier: broadcast where ``side`` is proven small,
    else a shuffle join whose frame side is salted."""
    if small:
        return frames.join(F.broadcast(side), frames["id"] == side["identifier"], "inner")
    salts = max(JOIN_SALTS, int(frames.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
    salted_frames = frames.withColumn(
        "_salt", F.pmod(F.xxhash64(*[F.col(c) for c in frames.columns]), F.lit(salts)))
    salted_side = side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return (salted_frames.join(salted_side, (salted_frames["id"] == salted_side["identifier"])
                               & (salted_frames["_salt"] == salted_side["_salt"]), "inner")
            .drop("_salt"))


def join_dictionary(frames: DataFrame, dictionary: SignalDictionary,
                    messages: DataFrame | None = None) -> DataFrame:
    """Inner equi-join ``frames.id = identifier``; unknown ids vanish and an
    id listed under two message names yields one row per name."""
    msgs = messages if messages is not None else dictionary.messages
    return _join(frames, msgs.select("identifier", "botschaft", "info"), dictionary.broadcastable)


def _with_word(frames: DataFrame, data_col: str) -> DataFrame:
    """Attach the payload word and size on the frame side, below the join: the
    join keeps the optimizer from inlining them into the per-signal
    expression, so they are computed once per frame, not once per signal."""
    return frames.withColumns({"_word": payload_word(data_col), "_n": F.size(data_col)})


def _with_hex_word(frames: DataFrame) -> DataFrame:
    """The same for hex payload text; payloads over 8 bytes also keep their
    digits, of which each signal takes the bytes it touches."""
    digits = frames.withColumn("_digits", hex_digits("data"))
    sized = digits.withColumns({"_word": hex_digits_word("_digits"), "_n": idiv(F.length("_digits"), 2).cast("int")})
    return sized.withColumn("_digits", F.when(F.col("_n") > 8, F.col("_digits")))


def _names(with_names: bool) -> list:
    return [F.col("info")["signal_name"].alias("names")] if with_names else []


def decode_frames_array(frames: DataFrame, dictionary: SignalDictionary,
                        keep: tuple = (), with_names: bool = False) -> DataFrame:
    """Raw frames (data array<int>) -> (ts, id, botschaft, vals array<bigint>)
    with values positional in the message's ``info`` order. ``with_names``
    carries the signal-name list through the join (column ``names``) so no
    driver-side lookup is needed downstream."""
    joined = join_dictionary(_with_word(frames, "data"), dictionary)
    return joined.select(*keep, "ts", "id", "botschaft", *_names(with_names),
                         decode_layout("info", dictionary.most_signals, "_word", "_n",
                                       lambda start, n: extract_bits("data", start, n, "_word", "_n")).alias("vals"))


def decode_text_array(frames: DataFrame, dictionary: SignalDictionary,
                      keep: tuple = (), with_names: bool = False) -> DataFrame:
    """Text frames (data hex string) -> positional values, as
    ``decode_frames_array``. A signal name listed twice in a message keeps the
    later layout."""
    joined = join_dictionary(_with_hex_word(frames), dictionary, dictionary.with_unique_names())
    return joined.select(*keep, "ts", "id", "botschaft", *_names(with_names),
                         decode_layout("info", dictionary.most_signals, "_word", "_n",
                                       lambda start, n: extract_hex_bits("_digits", start, n, "_word", "_n")).alias("vals"))


def decode_frames_map(frames: DataFrame, dictionary: SignalDictionary,
                      keep: tuple = (), with_names: bool = False) -> DataFrame:
    """Text frames (data hex string) -> (ts, id, botschaft, map<string,bigint>).
    ``with_names`` carries the layout's names (``names``, in dictionary
    order), which belong to the frame's id and message together. For rows,
    columns or ordered values use the long or array forms instead."""
    dec = decode_text_array(frames, dictionary, keep, with_names=True)
    return dec.select(*keep, "ts", "id", "botschaft", *(["names"] if with_names else []),
                      F.map_from_arrays("names", "vals").alias("map"))


def _long(frames: DataFrame, dictionary: SignalDictionary, data_col: str, unique: bool, keep: tuple) -> DataFrame:
    signals = dictionary.signal_rows(unique).withColumnsRenamed({"start": "_start", "len": "_len"})
    joined = _join(frames, signals, dictionary.signals_broadcastable)
    return joined.select(*keep, "ts", "id", "botschaft", "pos", "signal_name",
                         extract_bits(data_col, "_start", "_len", "_word", "_n").alias("value"))


def decode_frames_long(frames: DataFrame, dictionary: SignalDictionary,
                       data_col: str = "data", keep: tuple = ()) -> DataFrame:
    """Raw frames -> one row per (frame, signal): ts, id, botschaft,
    pos, signal_name, value."""
    return _long(_with_word(frames, data_col), dictionary, data_col, False, keep)


def decode_text_long(frames: DataFrame, dictionary: SignalDictionary, keep: tuple = ()) -> DataFrame:
    """Text frames (data hex string) -> the same; of signals with one name in
    a message the later layout only. Payloads over 8 bytes become byte arrays,
    once per frame, below the join."""
    worded = _with_hex_word(frames)
    return _long(worded.withColumn("_bytes", F.when(F.col("_n") > 8, hex_bytes("data"))), dictionary, "_bytes", True, keep)
