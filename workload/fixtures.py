"""Adapters from the driver's tables to transit inputs (the views of FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.plans.silver import delayed_stops, service_schedule

ZONE = "Australia/Melbourne"


# The columns that are read; declared, so that opening a table needs no job to infer them.
SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE,"
    " l_returnflag STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING",
    "customer": "c_custkey BIGINT, c_name STRING, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, props STRING",
}

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables.

    Each is a single file of one row group, which one task reads. What is built on them is spread by its own joins and
    groupings; ``events`` go through neither and are dealt out here, in parts that follow their size and the cores there are:
    with a part for each shuffle partition a stream over what they are written to would have as many more batches.
    """
    df = spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")
    return df.hint("rebalance", "event_id") if name == "events" else df


def updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat stop updates, one per line item.

    The join is a shuffled one also where a broadcast would do: a broadcast would leave all rows in the task that read them.
    """
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders").hint("shuffle_hash"), F.expr("l_orderkey = o_orderkey")
    )
    timed = lines.withColumn("midnight", F.expr("(19802 + o_orderkey % 30) * 86400")).withColumn(
        "due",
        F.expr(
            "midnight - 36000 + (4 + (l_orderkey*7 + l_linenumber) % 22)*3600"
            " + ((l_orderkey*11 + l_linenumber*3) % 60)*60 + (l_partkey*13 + l_suppkey) % 600 - 200"
        ),
    )
    return timed.selectExpr(
        "CAST(l_orderkey AS STRING) AS trip_id",
        "CAST(o_custkey % 50 AS STRING) AS route_id",
        "CASE l_returnflag WHEN 'R' THEN 'bus' WHEN 'A' THEN 'metro' ELSE 'tram' END AS mode",
        "DATE '2024-03-20' + CAST(o_orderkey % 30 AS INT) AS start_date",
        "l_linenumber AS stop_sequence",
        "CAST(l_suppkey AS STRING) AS stop_id",
        "midnight + (l_partkey*37 + l_suppkey*101 + CAST(l_quantity AS BIGINT)) % 10800 AS source_timestamp",
        "CASE WHEN l_partkey % 11 = 0 OR l_partkey % 53 = 0 THEN NULL ELSE due END AS stop_arrival_time",
        "CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE due + 20 END AS stop_departure_time",
    )


def _id(key: str, unmatched: str) -> str:
    """A key as text. Where ``unmatched`` holds it gets a form that realtime rows never use."""
    return f"CASE WHEN {unmatched} THEN concat('x', {key}) ELSE CAST({key} AS STRING) END"


def stop_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per scheduled stop; one trip in ten is unknown to the realtime side."""
    hour_minute = (
        "concat(lpad(CAST(4 + (l_orderkey*7 + l_linenumber) % 22 AS STRING), 2, '0'), ':',"
        " lpad(CAST((l_orderkey*11 + l_linenumber*3) % 60 AS STRING), 2, '0'), '{}')"
    )
    return (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_linenumber")
        .distinct()
        .selectExpr(
            f"{_id('l_orderkey', 'l_orderkey % 10 = 0')} AS trip_id",
            "l_linenumber AS stop_sequence",
            f"{hour_minute.format(':00')} AS arrival_time",
            f"{hour_minute.format(':20')} AS departure_time",
        )
    )


def _versions(first: DataFrame, second: DataFrame) -> DataFrame:
    """Two ingestions of a dimension."""
    return first.withColumn("ingested_at", F.expr("timestamp_seconds(1704067200)")).unionByName(
        second.withColumn("ingested_at", F.expr("timestamp_seconds(1706745600)"))
    )


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of each trip; the second moves one in three to another route. One in 17 is unknown."""
    orders = table(spark, sf_dir, "orders")
    trip_id = f"{_id('o_orderkey', 'o_orderkey % 17 = 0')} AS trip_id"
    moved = "(o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) % 50"
    return _versions(
        orders.selectExpr(trip_id, "CAST(o_custkey % 50 AS STRING) AS route_id", "o_orderpriority AS trip_headsign"),
        orders.selectExpr(trip_id, f"CAST({moved} AS STRING) AS route_id", "o_orderpriority AS trip_headsign"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each customer is a version of one of 50 routes, of which every 13th is unknown."""
    return table(spark, sf_dir, "customer").selectExpr(
        f"{_id('c_custkey % 50', 'c_custkey % 50 % 13 = 0')} AS route_id",
        "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS route_short_name",
        "c_name AS route_long_name",
        "timestamp_seconds(1704067200 + c_custkey) AS ingested_at",
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of each stop; the second renames every other one. One in nine is unknown."""
    suppliers = table(spark, sf_dir, "supplier")
    stop_id = f"{_id('s_suppkey', 's_suppkey % 9 = 0')} AS stop_id"
    return _versions(
        suppliers.selectExpr(stop_id, "s_name AS stop_name"),
        suppliers.selectExpr(stop_id, "concat(s_name, IF(s_suppkey % 2 = 0, ' v2', '')) AS stop_name"),
    )


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS STRING) AS entity_id",
        "CAST(user_id AS STRING) AS trip_id",
        "CAST(event_id % 60 AS STRING) AS route_id",
        "CASE event_id % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'metro' ELSE 'tram' END AS mode",
        "event_type AS label",
        "CAST(event_id % 181 - 90 AS DOUBLE) AS latitude",
        "CAST(event_id % 361 - 180 AS DOUBLE) AS longitude",
        # The column is a local timestamp without zone; read as UTC whatever the session zone is.
        "CAST(timestampdiff(SECOND, TIMESTAMP_NTZ '1970-01-01 00:00:00', ts) AS BIGINT)"
        " AS position_timestamp",
    )


def silver_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver rows straight from the flat updates, without the message encoding in between."""
    return delayed_stops(updates(spark, sf_dir), service_schedule(stop_times(spark, sf_dir)), ZONE)


HEADER = "named_struct('gtfs_realtime_version', '2.0', 'incrementality', 0, 'timestamp', {}) AS header"

# A quarter of the updates carry a second stop that the schedule does not know.
STOP_UPDATES = """
    array_compact(array(
        named_struct('stop_sequence', stop_sequence,
                     'arrival', IF(stop_arrival_time IS NULL, NULL, named_struct('time', stop_arrival_time)),
                     'departure', IF(stop_departure_time IS NULL, NULL, named_struct('time', stop_departure_time)),
                     'stop_id', stop_id, 'schedule_relationship', 0),
        IF(source_timestamp % 4 = 0,
           named_struct('stop_sequence', stop_sequence + 1000,
                        'arrival', CAST(NULL AS STRUCT<time: BIGINT>),
                        'departure', named_struct('time', stop_departure_time + 60),
                        'stop_id', stop_id, 'schedule_relationship', 1),
           NULL)))
"""


def trip_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded feed snapshots with ``mode``: one trip update and one alert-only entity each."""
    return updates(spark, sf_dir).selectExpr(
        "mode",
        HEADER.format("source_timestamp"),
        f"""array(
            named_struct('id', concat(trip_id, '-', stop_sequence),
                'vehicle', CAST(NULL AS {VEHICLE_ENTITY}),
                'trip_update', named_struct(
                    'trip', named_struct('trip_id', trip_id, 'route_id', route_id, 'start_time', '04:00:00',
                                         'start_date', date_format(start_date, 'yyyyMMdd'),
                                         'schedule_relationship', 0),
                    'stop_time_update', {STOP_UPDATES})),
            named_struct('id', 'alert', 'vehicle', NULL, 'trip_update', NULL)) AS entity""",
    )


VEHICLE_ENTITY = (
    "STRUCT<trip: STRUCT<trip_id: STRING, route_id: STRING, start_time: STRING, start_date: STRING>,"
    " vehicle: STRUCT<id: STRING, label: STRING>,"
    " position: STRUCT<latitude: DOUBLE, longitude: DOUBLE>, timestamp: BIGINT>"
)
TRIP_ENTITY = (
    "STRUCT<trip: STRUCT<trip_id: STRING, route_id: STRING, start_time: STRING, start_date: STRING,"
    " schedule_relationship: INT>,"
    " stop_time_update: ARRAY<STRUCT<stop_sequence: INT, arrival: STRUCT<time: BIGINT>,"
    " departure: STRUCT<time: BIGINT>, stop_id: STRING, schedule_relationship: INT>>>"
)


def vehicle_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded feed snapshots with ``mode``: one vehicle and one alert-only entity each.

    Every seventh vehicle has an unset trip id, which the wire format sends as empty text.
    """
    return positions(spark, sf_dir).selectExpr(
        "mode",
        HEADER.format("position_timestamp + 3"),
        f"""array(
            named_struct('id', 'alert', 'vehicle', NULL, 'trip_update', NULL),
            named_struct('id', entity_id,
                'vehicle', named_struct(
                    'trip', named_struct('trip_id', IF(CAST(entity_id AS BIGINT) % 7 = 0, '', trip_id),
                                         'route_id', route_id, 'start_time', '04:00:00',
                                         'start_date', '20240101'),
                    'vehicle', named_struct('id', concat('v', entity_id), 'label', label),
                    'position', named_struct('latitude', latitude, 'longitude', longitude),
                    'timestamp', position_timestamp),
                'trip_update', CAST(NULL AS {TRIP_ENTITY}))) AS entity""",
    )

