"""Sink shaping (statements, points, rows, cells, files) and delivery."""

from busframes.sinks.committed import RecordingStore, deliver_committed  # noqa: F401
from busframes.sinks.delivery import RecordingClient, deliver, write_jdbc, write_jdbc_by_key  # noqa: F401
from busframes.sinks.shaping import (  # noqa: F401
    insert_statements, line_protocol, unsigned_decimal, wide_store_rows,
)
