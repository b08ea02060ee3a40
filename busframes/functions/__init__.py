"""Column expressions; all run inside Catalyst (no Python workers)."""

from busframes.functions.bits import (  # noqa: F401
    bytes_to_hex, control_word_fields, decode_array, decode_map, extract_bits,
    hex_bytes, hex_id_to_int, hex_payload_size, hex_payload_word, merge_timestamp, payload_word, port_to_module, seconds_to_ns,
    signed_byte_to_unsigned,
)
from busframes.functions.timefmt import (  # noqa: F401
    hour_stamp, hour_stamp_to_millis, micros_to_millis_timestamp,
    micros_to_string, today_string,
)
