"""Decoded traces as a SQL table function.

``SELECT * FROM decode_trace(source pattern, id, first ts, last ts)`` over the
recordings of a time index. The function is plain SQL over a view of the
decoded long form, so the optimizer inlines it: its arguments become filters
that reach the recordings scan (``recordings`` format), which opens the chunks
that can hold an answer and builds the frames asked for. A null argument asks
for everything.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from busframes.operators.decode import decode_frames_long
from busframes.sources.dictionary import SignalDictionary
from busframes.sources.recordings_format import read_recordings


def register_decode_trace(spark: SparkSession, index: str, dictionary: SignalDictionary, name: str = "decode_trace") -> str:
    """Register the function ``name`` and its view ``<name>_rows`` in the
    session; nothing is read here."""
    frames = read_recordings(spark, index=index).filter(F.col("reason").isNull())
    view = f"{name}_rows"
    decode_frames_long(frames, dictionary, keep=("source", "module")).createOrReplaceTempView(view)
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(source_like STRING, frame_id INT, ts_from BIGINT, ts_to BIGINT)
        RETURNS TABLE (source STRING, module SMALLINT, ts BIGINT, id INT, botschaft STRING, signal_name STRING, value BIGINT)
        RETURN SELECT source, module, ts, id, botschaft, signal_name, value FROM {view}
        WHERE (source_like IS NULL OR source LIKE source_like) AND (frame_id IS NULL OR id = frame_id)
          AND (ts_from IS NULL OR ts >= ts_from) AND (ts_to IS NULL OR ts <= ts_to)""")
    return name
