"""Event timestamp and its hour partition, from epoch seconds."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EVENT_PARTITIONS = ("year", "month", "day", "hour")

# Years 1 to 9999; anything outside is a corrupt clock and must not fail the stream.
_FIRST_SECOND = -62135596800
_LAST_SECOND = 253402300799


def with_event_parts(df: DataFrame, epoch: str = "source_timestamp") -> DataFrame:
    """Add ``event_ts`` and the UTC ``year``, ``month``, ``day`` and ``hour`` of an epoch-second column.

    Pure arithmetic, so the partition a row lands in never depends on the session time zone.
    """
    seconds = F.when(F.col(epoch).between(_FIRST_SECOND, _LAST_SECOND), F.col(epoch))
    date = F.date_from_unix_date(F.floor(seconds / 86400).cast("int"))
    return df.select(
        "*",
        F.timestamp_seconds(seconds).alias("event_ts"),
        F.year(date).alias("year"),
        F.month(date).alias("month"),
        F.dayofmonth(date).alias("day"),
        F.floor(F.pmod(seconds, F.lit(86400)) / 3600).cast("int").alias("hour"),
    )


def from_hour(epoch: int) -> Column:
    """Partition filter for the hour of ``epoch`` and later.

    Spark cannot derive it from a bound on the timestamp itself. Written on the partition columns it selects
    directories before anything is read.
    """
    bound = F.struct(*(F.lit(value).alias(name) for name, value in zip(EVENT_PARTITIONS, hour_of(epoch))))
    return F.struct(*EVENT_PARTITIONS) >= bound


def hour_of(epoch: int) -> tuple[int, ...]:
    """Year, month, day and hour of an instant in UTC."""
    at = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=epoch)
    return tuple(getattr(at, name) for name in EVENT_PARTITIONS)


def epoch_of(hour: tuple[int, ...]) -> int:
    """The first second of an hour given as year, month, day and hour in UTC."""
    return int((dt.datetime(*hour) - dt.datetime(1970, 1, 1)).total_seconds())
