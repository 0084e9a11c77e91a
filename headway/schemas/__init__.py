"""Declared message and table schemas, and the loader for schemas kept as JSON files."""

from __future__ import annotations

import json

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
    TimestampType,
)

TEXT, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()


def fields(**columns: DataType) -> StructType:
    """A struct of nullable fields, in the order given."""
    struct = StructType()
    for name, kind in columns.items():
        struct = struct.add(name, kind)
    return struct


HEADER = fields(gtfs_realtime_version=TEXT, incrementality=INT, timestamp=LONG)
_TRIP = {"trip_id": TEXT, "route_id": TEXT, "start_time": TEXT, "start_date": TEXT}
_POSITION = fields(latitude=DOUBLE, longitude=DOUBLE)
_STOP_EVENT = fields(time=LONG)
_STOP_TIME_UPDATE = fields(
    stop_sequence=INT, arrival=_STOP_EVENT, departure=_STOP_EVENT, stop_id=TEXT, schedule_relationship=INT
)
_TRIP_UPDATE = fields(
    trip=fields(**_TRIP, schedule_relationship=INT), stop_time_update=ArrayType(_STOP_TIME_UPDATE)
)


def _vehicle(**descriptor: DataType) -> StructType:
    return fields(trip=fields(**_TRIP), vehicle=fields(**descriptor), position=_POSITION, timestamp=LONG)


TRIP_UPDATE_MESSAGE = fields(header=HEADER, entity_id=TEXT, mode=TEXT, trip_update=_TRIP_UPDATE)

VEHICLE_POSITION_MESSAGE = fields(
    mode=TEXT, header=HEADER, entity_id=TEXT, vehicle=_vehicle(vehicle_id=TEXT, label=TEXT)
)

# One decoded feed poll: a header and its entities, each holding a vehicle, a trip update or neither.
FEED_SNAPSHOT = fields(
    header=HEADER,
    entity=ArrayType(fields(id=TEXT, vehicle=_vehicle(id=TEXT, label=TEXT), trip_update=_TRIP_UPDATE)),
)

# Columns of a topic record; only ``value`` is read by the jobs.
TOPIC_RECORD = fields(
    key=BinaryType(), value=BinaryType(), topic=TEXT, partition=INT, offset=LONG, timestamp=TimestampType()
)

# The silver table of trip updates, as the stream writes it and the marts read it.
SILVER_TRIP_UPDATES = fields(
    mode=TEXT,
    gtfs_realtime_version=TEXT,
    source_timestamp=LONG,
    entity_id=TEXT,
    trip_id=TEXT,
    route_id=TEXT,
    start_time=TEXT,
    start_date=DateType(),
    trip_schedule_relationship=INT,
    stop_sequence=INT,
    stop_id=TEXT,
    stop_arrival_time=LONG,
    stop_departure_time=LONG,
    schedule_relationship=INT,
    effective_stop_time=LONG,
    effective_stop_time_calculation_method=TEXT,
    scheduled_stop_time=LONG,
    departure_time=TEXT,
    delay_seconds=LONG,
    event_ts=TimestampType(),
    year=INT,
    month=INT,
    day=INT,
    hour=INT,
)

# Where in a trip-update message the silver columns come from, and where in one of its stop updates.
TRIP_UPDATE_SOURCES = {
    "mode": "mode",
    "gtfs_realtime_version": "header.gtfs_realtime_version",
    "source_timestamp": "header.timestamp",
    "entity_id": "entity_id",
    "trip_id": "trip_update.trip.trip_id",
    "route_id": "trip_update.trip.route_id",
    "start_time": "trip_update.trip.start_time",
    "start_date": "trip_update.trip.start_date",
    "trip_schedule_relationship": "trip_update.trip.schedule_relationship",
}
STOP_UPDATE_SOURCES = {
    "stop_sequence": "stop_sequence",
    "stop_id": "stop_id",
    "stop_arrival_time": "arrival.time",
    "stop_departure_time": "departure.time",
    "schedule_relationship": "schedule_relationship",
}

# Where in a vehicle message the silver columns come from.
VEHICLE_POSITION_SOURCES = {
    "mode": "mode",
    "gtfs_realtime_version": "header.gtfs_realtime_version",
    "source_timestamp": "header.timestamp",
    "entity_id": "entity_id",
    "trip_id": "vehicle.trip.trip_id",
    "route_id": "vehicle.trip.route_id",
    "start_time": "vehicle.trip.start_time",
    "start_date": "vehicle.trip.start_date",
    "vehicle_id": "vehicle.vehicle.vehicle_id",
    "label": "vehicle.vehicle.label",
    "latitude": "vehicle.position.latitude",
    "longitude": "vehicle.position.longitude",
    "position_timestamp": "vehicle.timestamp",
}

# The silver table of vehicle positions; the service date stays text.
SILVER_VEHICLE_POSITIONS = fields(
    mode=TEXT,
    gtfs_realtime_version=TEXT,
    source_timestamp=LONG,
    entity_id=TEXT,
    trip_id=TEXT,
    route_id=TEXT,
    start_time=TEXT,
    start_date=TEXT,
    vehicle_id=TEXT,
    label=TEXT,
    latitude=DOUBLE,
    longitude=DOUBLE,
    position_timestamp=LONG,
    event_ts=TimestampType(),
    year=INT,
    month=INT,
    day=INT,
    hour=INT,
)


def load_schema(path: str) -> StructType:
    """Read a schema from a file in Spark's own JSON schema format."""
    with open(path, encoding="utf-8") as file:
        return StructType.fromJson(json.load(file))
