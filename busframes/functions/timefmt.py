"""Time conversions and formats (session time zone is UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from busframes.functions.bits import _c, idiv

# Fixed output formats of the jobs.
MICROS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
MILLIS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"
HOUR_STAMP_FORMAT = "yyyyMMddHH"
DAY_FORMAT = "yyyy-MM-dd"


def micros_to_string(ts_us) -> Column:
    """µs since epoch -> ``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    return F.date_format(F.timestamp_micros(_c(ts_us)), MICROS_FORMAT)


def micros_to_millis_timestamp(ts_us) -> Column:
    """µs -> ms (integer division) -> timestamp, as the row-store sinks bind it."""
    return F.timestamp_millis(idiv(_c(ts_us).cast("bigint"), 1000))


def hour_stamp(ts_us) -> Column:
    """µs -> ``yyyyMMddHH`` hour stamp."""
    return F.date_format(F.timestamp_micros(_c(ts_us)), HOUR_STAMP_FORMAT)


def hour_stamp_to_millis(stamp) -> Column:
    """``yyyyMMddHH`` (UTC) -> ms since epoch; null if malformed."""
    ts = F.try_to_timestamp(_c(stamp), F.lit(HOUR_STAMP_FORMAT))
    return F.unix_millis(ts)


def today_string() -> Column:
    return F.date_format(F.current_date(), DAY_FORMAT)
