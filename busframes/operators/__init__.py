"""Join + decode, reshaping, batching and partitioned writes."""

from busframes.operators.decode import (  # noqa: F401
    decode_frames_array, decode_frames_long, decode_frames_map, decode_text_array, decode_text_long, join_dictionary,
)
