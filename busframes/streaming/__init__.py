"""The decode pipeline over a growing directory of traces."""

from busframes.streaming.trace_stream import decode_binary_stream, decode_text_stream  # noqa: F401
