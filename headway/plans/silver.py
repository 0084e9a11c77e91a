"""Silver tables: topic records to flat, enriched, hour-partitioned rows. Each function takes batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from headway.functions import is_service_time, local_epoch, seconds_late, service_seconds, with_event_parts
from headway.operators.enrich import join_static, with_effective_time, with_resolved_names
from headway.operators.messages import flatten_trip_updates, flatten_vehicle_positions, parse_value
from headway.schemas import TRIP_UPDATE_MESSAGE, VEHICLE_POSITION_MESSAGE

STOP_TIME_KEYS = ("trip_id", "stop_sequence")
STOP_TIME_COLUMNS = ("trip_id", "arrival_time", "departure_time", "stop_sequence")
ROUTE_COLUMNS = ("route_id", "route_short_name", "route_long_name")
TRIP_COLUMNS = ("trip_id", "trip_headsign")
TRIP_KEYS = ("trip_id",)


def silver_trip_updates(records: DataFrame, schedule: DataFrame, zone: str) -> DataFrame:
    """Stop updates with their schedule, delay and event hour; rows without a schedule or a time are dropped.

    ``schedule`` comes from ``service_schedule``.
    """
    return delayed_stops(flat_trip_updates(records), schedule, zone)


def flat_trip_updates(records: DataFrame, schema: StructType = TRIP_UPDATE_MESSAGE) -> DataFrame:
    """Parsed stop updates, ``start_date`` as a date."""
    return flatten_trip_updates(parse_value(records, schema), typed_date=True)


def service_schedule(stop_times: DataFrame) -> DataFrame:
    """``stop_times`` with usable times, their arrival as ``service_seconds``; a stream should read a stored one."""
    return stop_times.filter(is_service_time("arrival_time")).select(
        *STOP_TIME_KEYS, service_seconds("arrival_time").alias("service_seconds"), "departure_time"
    )


def delayed_stops(stops: DataFrame, schedule: DataFrame, zone: str) -> DataFrame:
    """Join flat stop updates (``start_date`` a date) with a ``service_schedule``; derive delay and event hour.

    Only rows whose effective and scheduled times are known have a delay. The schedule time is known when its
    date and its time of day are, so each side is filtered by itself and the join can be an inner one. Times of
    day are parsed on the schedule side, once per scheduled stop.
    """
    timed = with_effective_time(stops).filter("effective_stop_time IS NOT NULL AND start_date IS NOT NULL")
    joined = join_static(timed, schedule, STOP_TIME_KEYS, how="inner")
    scheduled = joined.select(
        *timed.columns,
        local_epoch("start_date", "service_seconds", zone).alias("scheduled_stop_time"),
        "departure_time",
    )
    delayed = scheduled.select("*", seconds_late("effective_stop_time", "scheduled_stop_time").alias("delay_seconds"))
    return with_event_parts(delayed)


def silver_vehicle_positions(records: DataFrame, schema: StructType = VEHICLE_POSITION_MESSAGE) -> DataFrame:
    """Vehicle positions with their event hour."""
    return with_event_parts(flatten_vehicle_positions(parse_value(records, schema)))


def named_positions(positions: DataFrame, routes: DataFrame, trips: DataFrame) -> DataFrame:
    """Positions with route and trip names and their fallbacks."""
    with_routes = join_static(positions, routes.select(*ROUTE_COLUMNS), ["route_id"])
    with_trips = join_static(with_routes, trips.select(*TRIP_COLUMNS), ["trip_id"])
    return with_resolved_names(with_trips)
