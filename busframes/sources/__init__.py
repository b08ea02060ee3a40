"""Scans: text traces, binary recordings, the signal dictionary."""

from busframes.sources.binary_trace import (  # noqa: F401
    FRAMED_SCHEMA, frame_records, read_binary_trace, read_raw_files,
)
from busframes.sources.dictionary import (  # noqa: F401
    DICTIONARY_COLUMNS, SignalDictionary, aggregate_dictionary, read_dictionary,
)
from busframes.sources.text_trace import (  # noqa: F401
    keep_frame_lines, parse_text_lines, read_text_trace, tokenize,
)
