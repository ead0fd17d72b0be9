"""Date and time helpers free of the session time zone.

TIMESTAMP_NTZ values are wall-clock readings. Some built-ins (formatting,
``timestamp_diff``) pass them through the session time zone, where a local
time inside a daylight-saving gap moves by an hour. These helpers use only
date and clock parts.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def wall_seconds(c) -> Column:
    """Seconds since 1970-01-01 00:00 of a wall-clock timestamp (BIGINT)."""
    c = F.col(c) if isinstance(c, str) else c
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.floor(F.second(c)).cast("bigint")


def seconds_between(start, end) -> Column:
    return wall_seconds(end) - wall_seconds(start)


def time_of_day(c) -> Column:
    """Clock part of a wall-clock timestamp as ``HH:mm:ss`` (``ts::TIME``)."""
    c = F.col(c) if isinstance(c, str) else c
    two = [F.lpad(x.cast("string"), 2, "0") for x in (F.hour(c), F.minute(c), F.floor(F.second(c)).cast("int"))]
    return F.concat(two[0], F.lit(":"), two[1], F.lit(":"), two[2])
