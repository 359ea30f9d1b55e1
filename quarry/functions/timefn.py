"""Time column expressions.

Trip times are ``TIMESTAMP_NTZ`` (local date-times).  Differences are taken
with ``timestampdiff`` on the NTZ values: no cast through the session time
zone, so daylight-saving changes and the caller's zone never alter a duration.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions._columns import col_of

from quarry.config import TIME_FORMAT


def duration_sec(start: Column | str, end: Column | str) -> Column:
    """Whole seconds from ``start`` to ``end`` (negative when reversed)."""
    return F.timestamp_diff("SECOND", col_of(start), col_of(end))


def duration_min(start: Column | str, end: Column | str) -> Column:
    """Minutes from ``start`` to ``end`` as a double."""
    return duration_sec(start, end) / F.lit(60.0)


def speed_kmh(distance_km: Column | str, minutes: Column | str) -> Column:
    """km/h from a distance and a duration in minutes.

    ``try_divide`` gives null instead of an ANSI error on a zero duration; on
    cleaned trips the duration is always positive.
    """
    return F.try_divide(col_of(distance_km), col_of(minutes) / F.lit(60.0))


def speed_ieee(distance_km: Column | str, minutes: Column | str) -> Column:
    """km/h by IEEE division: a zero duration gives infinity, or NaN when the distance is zero too."""
    distance, zero = col_of(distance_km), col_of(minutes) == F.lit(0.0)
    return (F.when(zero & (distance > 0), F.lit(float("inf")))
            .when(zero & distance.isNotNull(), F.lit(float("nan")))
            .otherwise(speed_kmh(distance, minutes)))


def parse_ntz(text: Column | str, fmt: str = TIME_FORMAT) -> Column:
    """Parse a local date-time by pattern into ``TIMESTAMP_NTZ``; null when malformed.

    ``from_csv`` parses straight to NTZ with the given pattern (no session zone
    involved) and, in its default permissive mode, yields null for bad text.
    """
    opts = {"timestampNTZFormat": fmt, "mode": "PERMISSIVE", "sep": "\u0001", "quote": "\u0000"}
    return F.from_csv(col_of(text), "t TIMESTAMP_NTZ", opts).getField("t")


def format_ntz(ts: Column | str, fmt: str = TIME_FORMAT) -> Column:
    """Render a timestamp with a pattern."""
    return F.date_format(col_of(ts), fmt)
