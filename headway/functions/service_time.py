"""Schedule times: a service date plus ``HH:MM:SS``, where the hour may pass 24. Arguments are column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SERVICE_TIME = r"^\s*\d{1,6}:[0-5]?\d:[0-5]?\d\s*$"


def service_date(text: str) -> Column:
    """Date from ``yyyyMMdd`` text; NULL when it is not one."""
    return F.try_to_date(text, "yyyyMMdd")


def is_service_time(time: str) -> Column:
    """Whether the text is a usable ``HH:MM:SS``; one test, so that it stays cheap as a pushed-down filter."""
    return F.col(time).rlike(_SERVICE_TIME)


def service_seconds(time: str) -> Column:
    """Seconds into the service day; NULL when the text is not ``HH:MM:SS``. Hours from 24 on are later days."""
    parts = F.split(F.trim(time), ":")
    hour, minute, second = (F.get(parts, F.lit(i)).try_cast("long") for i in range(3))
    return F.when(is_service_time(time), (hour * 60 + minute) * 60 + second)


def local_epoch(date: str, seconds: str, zone: str) -> Column:
    """UTC epoch seconds of a wall clock given as a date and seconds into it.

    The wall clock is built arithmetically and then shifted from ``zone`` to UTC, which is where daylight saving
    is resolved. The session time zone has no part in it.
    """
    wall_clock = F.timestamp_seconds(F.unix_date(date).cast("long") * 86400 + F.col(seconds))
    return F.unix_seconds(F.to_utc_timestamp(wall_clock, F.lit(zone)))


def seconds_late(effective: str, scheduled: str) -> Column:
    """Delay in seconds, negative when early; NULL when either time is unknown or absurd."""
    return F.try_subtract(effective, scheduled)
