"""Feed snapshots to self-contained messages, one per entity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _id(column: Column) -> Column:
    """Wire formats send an unset id as empty text; it must not act as a value."""
    return F.nullif(column, F.lit(""))


def _number(column: Column) -> Column:
    """Scalar fields that are unset on the wire read as zero."""
    return F.coalesce(column, F.lit(0))


def _stop_time(event: Column) -> Column:
    """An arrival or departure; absent stays NULL and a zero time counts as no time."""
    time = F.nullif(event["time"], F.lit(0).cast("long"))
    return F.when(event.isNotNull(), F.struct(time.alias("time")))


def _stop_update(stop: Column) -> Column:
    return F.struct(
        _number(stop["stop_sequence"]).alias("stop_sequence"),
        _stop_time(stop["arrival"]).alias("arrival"),
        _stop_time(stop["departure"]).alias("departure"),
        _id(stop["stop_id"]).alias("stop_id"),
        _number(stop["schedule_relationship"]).alias("schedule_relationship"),
    )


def _header() -> Column:
    return F.struct(
        F.col("header.gtfs_realtime_version").alias("gtfs_realtime_version"),
        _number(F.col("header.incrementality")).alias("incrementality"),
        F.col("header.timestamp").alias("timestamp"),
    )


def _trip_fields(trip: Column) -> list[Column]:
    return [
        _id(trip["trip_id"]).alias("trip_id"),
        _id(trip["route_id"]).alias("route_id"),
        trip["start_time"].alias("start_time"),
        trip["start_date"].alias("start_date"),
    ]


def _entities(snapshots: DataFrame, kind: str) -> DataFrame:
    """Explode the entities that carry ``kind``, with the snapshot's header and mode."""
    wanted = F.filter("entity", lambda e: e[kind].isNotNull())
    return snapshots.select("mode", _header().alias("header"), F.explode(wanted).alias("e"))


def vehicle_messages(snapshots: DataFrame) -> DataFrame:
    """Vehicle-position messages of a frame with ``mode``, ``header`` and ``entity``."""
    vehicle = F.col("e.vehicle")
    record = F.struct(
        F.struct(*_trip_fields(vehicle["trip"])).alias("trip"),
        F.struct(
            _id(vehicle["vehicle"]["id"]).alias("vehicle_id"), vehicle["vehicle"]["label"].alias("label")
        ).alias("vehicle"),
        F.struct(
            _number(vehicle["position"]["latitude"]).alias("latitude"),
            _number(vehicle["position"]["longitude"]).alias("longitude"),
        ).alias("position"),
        vehicle["timestamp"].alias("timestamp"),
    )
    return _entities(snapshots, "vehicle").select(
        "mode", "header", _id(F.col("e.id")).alias("entity_id"), record.alias("vehicle")
    )


def trip_update_messages(snapshots: DataFrame) -> DataFrame:
    """Trip-update messages of a frame with ``mode``, ``header`` and ``entity``."""
    update = F.col("e.trip_update")
    relationship = _number(update["trip"]["schedule_relationship"]).alias("schedule_relationship")
    stops = F.coalesce(update["stop_time_update"], F.array())
    record = F.struct(
        F.struct(*_trip_fields(update["trip"]), relationship).alias("trip"),
        F.transform(stops, _stop_update).alias("stop_time_update"),
    )
    return _entities(snapshots, "trip_update").select(
        "header", _id(F.col("e.id")).alias("entity_id"), "mode", record.alias("trip_update")
    )


def union_feeds(snapshots_by_mode: dict[str, DataFrame]) -> DataFrame:
    """Tag each mode's snapshots with the mode and merge them, batch or stream."""
    tagged = [df.withColumn("mode", F.lit(mode)) for mode, df in snapshots_by_mode.items()]
    return reduce(DataFrame.unionByName, tagged)
