"""SQL counterparts of the registered queries, for DuckDB over the same tables."""

from __future__ import annotations

from workload.queries import LANDED_AT, NOW, READ_AT, SPLIT

_MIDNIGHT = "((19802 + o.o_orderkey % 30)*86400)"
_DUE = (
    f"({_MIDNIGHT} - 36000 + (4 + (l.l_orderkey*7 + l.l_linenumber) % 22)*3600"
    " + ((l.l_orderkey*11 + l.l_linenumber*3) % 60)*60 + (l.l_partkey*13 + l.l_suppkey) % 600 - 200)"
)
_HH_MM = (
    "concat(lpad(CAST(4 + (l.l_orderkey*7 + l.l_linenumber) % 22 AS VARCHAR), 2, '0'), ':',"
    " lpad(CAST((l.l_orderkey*11 + l.l_linenumber*3) % 60 AS VARCHAR), 2, '0'), {})"
)


def _id(key: str, unmatched: str) -> str:
    return f"CASE WHEN {unmatched} THEN concat('x', {key}) ELSE CAST({key} AS VARCHAR) END"


_TRAM = "ascii(right(trip_id, 1)) % 3 = 2"

_VIEWS = {
    "updates": f"""
        SELECT CAST(l.l_orderkey AS VARCHAR) AS trip_id, CAST(o.o_custkey % 50 AS VARCHAR) AS route_id,
            CASE l.l_returnflag WHEN 'R' THEN 'bus' WHEN 'A' THEN 'metro' ELSE 'tram' END AS mode,
            DATE '2024-03-20' + CAST(o.o_orderkey % 30 AS INT) AS start_date,
            l.l_linenumber AS stop_sequence, CAST(l.l_suppkey AS VARCHAR) AS stop_id,
            {_MIDNIGHT} + (l.l_partkey*37 + l.l_suppkey*101 + CAST(l.l_quantity AS BIGINT)) % 10800 AS source_timestamp,
            CASE WHEN l.l_partkey % 11 = 0 OR l.l_partkey % 53 = 0 THEN NULL ELSE {_DUE} END AS stop_arrival_time,
            CASE WHEN l.l_partkey % 53 = 0 THEN NULL ELSE {_DUE} + 20 END AS stop_departure_time
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "stop_times": f"""
        SELECT DISTINCT {_id("l.l_orderkey", "l.l_orderkey % 10 = 0")} AS trip_id, l.l_linenumber AS stop_sequence,
            {_HH_MM.format("':00'")} AS arrival_time, {_HH_MM.format("':20'")} AS departure_time
        FROM lineitem l""",
    "trips": f"""
        SELECT {_id("o_orderkey", "o_orderkey % 17 = 0")} AS trip_id, CAST(o_custkey % 50 AS VARCHAR) AS route_id,
            o_orderpriority AS trip_headsign, 1 AS version
        FROM orders
        UNION ALL
        SELECT {_id("o_orderkey", "o_orderkey % 17 = 0")},
            CAST((o_custkey + CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END) % 50 AS VARCHAR), o_orderpriority, 2
        FROM orders""",
    "routes": f"""
        SELECT {_id("c_custkey % 50", "c_custkey % 50 % 13 = 0")} AS route_id,
            CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS route_short_name,
            c_name AS route_long_name, c_custkey AS version
        FROM customer""",
    "stops": f"""
        SELECT {_id("s_suppkey", "s_suppkey % 9 = 0")} AS stop_id, s_name AS stop_name, 1 AS version
        FROM supplier
        UNION ALL
        SELECT {_id("s_suppkey", "s_suppkey % 9 = 0")},
            concat(s_name, CASE WHEN s_suppkey % 2 = 0 THEN ' v2' ELSE '' END), 2
        FROM supplier""",
    "positions": """
        SELECT CAST(event_id AS VARCHAR) AS entity_id,
            CASE WHEN event_id % 7 = 0 THEN NULL ELSE CAST(user_id AS VARCHAR) END AS trip_id,
            CAST(event_id % 60 AS VARCHAR) AS route_id,
            CASE event_id % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'metro' ELSE 'tram' END AS mode,
            event_type AS label, CAST(event_id % 181 - 90 AS DOUBLE) AS latitude,
            CAST(event_id % 361 - 180 AS DOUBLE) AS longitude,
            CAST(floor(epoch(ts)) AS BIGINT) AS position_timestamp,
            CAST(floor(epoch(ts)) AS BIGINT) + 3 AS source_timestamp
        FROM events""",
    "latest_trips": """
        SELECT trip_id, unnest(newest)
        FROM (SELECT trip_id, arg_max({'route_id': route_id, 'trip_headsign': trip_headsign}, version) AS newest
            FROM trips GROUP BY trip_id)""",
    "latest_routes": """
        SELECT route_id, unnest(newest)
        FROM (SELECT route_id, arg_max({'route_short_name': route_short_name, 'route_long_name': route_long_name}, version) AS newest
            FROM routes GROUP BY route_id)""",
    "latest_stops": """
        SELECT stop_id, unnest(newest)
        FROM (SELECT stop_id, arg_max({'stop_name': stop_name}, version) AS newest
            FROM stops GROUP BY stop_id)""",
}


def _scheduled(date: str, time: str, zone: str) -> str:
    wall_clock = (
        f"CAST({date} AS TIMESTAMP) + to_hours(CAST(split_part({time}, ':', 1) AS BIGINT))"
        f" + to_minutes(CAST(split_part({time}, ':', 2) AS BIGINT))"
        f" + to_seconds(CAST(split_part({time}, ':', 3) AS BIGINT))"
    )
    return f"CAST(epoch(timezone('{zone}', {wall_clock})) AS BIGINT)"


def _parts(epoch: str) -> str:
    at = f"make_timestamp({epoch} * 1000000)"
    return ", ".join(f"CAST({part}({at}) AS INTEGER) AS {part}" for part in ("year", "month", "day", "hour"))


_METHOD = (
    "CASE WHEN stop_arrival_time IS NOT NULL THEN 'arrival'"
    " WHEN stop_departure_time IS NOT NULL THEN 'departure' END"
)

# Silver rows; the flat form first, the form that went through messages adds their constants.
_VIEWS["flat_silver"] = f"""
    SELECT u.trip_id, u.route_id, u.mode, u.start_date, u.stop_sequence, u.stop_id, u.source_timestamp,
        u.stop_arrival_time, u.stop_departure_time,
        coalesce(u.stop_arrival_time, u.stop_departure_time) AS effective_stop_time,
        {_METHOD} AS effective_stop_time_calculation_method,
        {_scheduled("u.start_date", "s.arrival_time", "Australia/Melbourne")} AS scheduled_stop_time,
        s.departure_time,
        coalesce(u.stop_arrival_time, u.stop_departure_time)
            - {_scheduled("u.start_date", "s.arrival_time", "Australia/Melbourne")} AS delay_seconds,
        u.source_timestamp AS event_ts, {_parts("u.source_timestamp")}
    FROM updates u JOIN stop_times s ON u.trip_id = s.trip_id AND u.stop_sequence = s.stop_sequence
    WHERE coalesce(u.stop_arrival_time, u.stop_departure_time) IS NOT NULL"""

_SILVER_TRIPS = """
    SELECT *, '2.0' AS gtfs_realtime_version, concat(trip_id, '-', stop_sequence) AS entity_id,
        '04:00:00' AS start_time, 0 AS trip_schedule_relationship, 0 AS schedule_relationship
    FROM flat_silver"""

# The streaming jobs read per-mode schedule files, of which the tram ones have no departure_time.
_SILVER_TRIPS_STREAM = f"""
    SELECT * REPLACE (CASE WHEN {_TRAM} THEN NULL ELSE departure_time END AS departure_time)
    FROM ({_SILVER_TRIPS})"""

_SILVER_VEHICLES = f"""
    SELECT mode, '2.0' AS gtfs_realtime_version, source_timestamp, entity_id, trip_id, route_id,
        '04:00:00' AS start_time, '20240101' AS start_date, concat('v', entity_id) AS vehicle_id, label,
        latitude, longitude, position_timestamp, source_timestamp AS event_ts, {_parts("source_timestamp")}
    FROM positions"""

_KEYS = "trip_id, route_id, year, month, day, hour, stop_sequence"
_ALL_TIES = (
    "mode", "start_date", "stop_id", "stop_arrival_time", "stop_departure_time", "effective_stop_time",
    "effective_stop_time_calculation_method", "scheduled_stop_time", "departure_time", "delay_seconds",
)
_SHORT_TIES = ("stop_id", "mode", "delay_seconds")


def _dedup(source: str, ties: tuple[str, ...]) -> str:
    order = ", ".join(f"{name} DESC NULLS LAST" for name in ("source_timestamp", *ties))
    return f"SELECT DISTINCT ON ({_KEYS}) * FROM {source} ORDER BY {_KEYS}, {order}"


_VIEWS["deduped"] = _dedup("flat_silver", _SHORT_TIES)
_VIEWS["deduped_all_ties"] = _dedup("flat_silver", _ALL_TIES)

_HOUR = "mode, year, month, day, hour"
_COUNTS = "count(*) AS total_stops, count(*) FILTER (delay_seconds < 30) AS on_time_stops"


def _stop_hourly(deduped: str) -> str:
    return f"""
        SELECT stop_id, {_HOUR}, {_COUNTS},
            (SELECT l.stop_name FROM latest_stops l WHERE l.stop_id = d.stop_id) AS stop_name
        FROM {deduped} d GROUP BY stop_id, {_HOUR}"""


def _route_hourly(deduped: str) -> str:
    return f"""
        SELECT routed.route_id, {_HOUR}, {_COUNTS}, any_value(route_short_name) AS route_short_name,
            any_value(route_long_name) AS route_long_name
        FROM (
            SELECT d.* REPLACE ((SELECT l.route_id FROM latest_trips l WHERE l.trip_id = d.trip_id) AS route_id)
            FROM {deduped} d) routed
        LEFT JOIN latest_routes USING (route_id)
        GROUP BY routed.route_id, {_HOUR}"""


_NAMED = """
    SELECT p.*, coalesce(r.route_short_name, r.route_long_name, p.route_id, 'UNKNOWN_ROUTE') AS resolved_route_name,
        coalesce(t.trip_headsign, 'UNKNOWN_DESTINATION') AS resolved_headsign
    FROM positions p LEFT JOIN latest_routes r ON p.route_id = r.route_id
    LEFT JOIN latest_trips t ON p.trip_id = t.trip_id"""


def _live(prefix: str, source: str, fields: dict[str, str], order: tuple[str, ...]) -> str:
    ranking = ", ".join(f"{name} DESC NULLS LAST" for name in (*order, *fields.values()))
    shown = ", ".join(f"{text} AS {name}" for name, text in fields.items())
    return f"""
        SELECT concat('{prefix}:trip:', trip_id) AS "key", {shown}, CAST({NOW + 120} AS BIGINT) AS expires_at
        FROM ({source}) WHERE trip_id IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY trip_id ORDER BY {ranking}) = 1"""


_LIVE_DELAY = _live(
    "delay",
    "SELECT * FROM flat_silver",
    {"trip_id": "trip_id", "last_stop_sequence": "stop_sequence", "delay_seconds": "delay_seconds"},
    ("source_timestamp", "stop_sequence"),
)
_LIVE_VEHICLE = _live(
    "vehicle",
    _NAMED,
    {
        "trip_id": "trip_id",
        "mode": "mode",
        "route_id": "route_id",
        "route_name": "resolved_route_name",
        "headsign": "resolved_headsign",
        "latitude": "latitude",
        "longitude": "longitude",
        "label": "label",
        "timestamp": "position_timestamp",
    },
    ("position_timestamp", "source_timestamp"),
)

_LANDING = (
    "CASE CAST(trip_id AS BIGINT) % 4 WHEN 0 THEN 0 WHEN 1 THEN CAST(entity_id AS BIGINT) % 2 * 2"
    " WHEN 2 THEN CAST(entity_id AS BIGINT) % 2 ELSE CAST(entity_id AS BIGINT) % 3 END"
)
# Written at the time of its landing, a row counts at reading time if each later landing of its trip came before the
# trip had expired, and the last of them has not expired either.
_LIVE_EXPIRY = f"""
    WITH timed AS (
        SELECT *, list_value{LANDED_AT}[{_LANDING} + 1] AS landing FROM ({_NAMED}) WHERE trip_id IS NOT NULL),
    landed AS (SELECT DISTINCT trip_id, landing FROM timed),
    gaps AS (
        SELECT trip_id, landing, coalesce(lead(landing) OVER later, {READ_AT}) - landing AS gap
        FROM landed WINDOW later AS (PARTITION BY trip_id ORDER BY landing)),
    lives AS (
        SELECT trip_id, max(landing) AS newest, coalesce(max(landing) FILTER (gap >= 120), -1) AS died
        FROM gaps GROUP BY trip_id)
    SELECT concat('vehicle:trip:', trip_id) AS "key", trip_id, mode, route_id, resolved_route_name AS route_name,
        resolved_headsign AS headsign, latitude, longitude, label, position_timestamp AS timestamp,
        CAST({NOW + 120} + newest AS BIGINT) AS expires_at
    FROM timed JOIN lives USING (trip_id) WHERE landing > died
    QUALIFY row_number() OVER (
        PARTITION BY trip_id
        ORDER BY position_timestamp DESC, source_timestamp DESC, mode DESC, route_id DESC, resolved_route_name DESC,
            resolved_headsign DESC, latitude DESC, longitude DESC, label DESC) = 1"""

_TRIP_FIELDS = (
    "trip_id, route_id, '04:00:00' AS start_time, strftime(start_date, '%Y%m%d') AS start_date"
)
_SECOND = "source_timestamp % 4 = 0"

_ORACLES = {
    "parse_message": "SELECT CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events",
    "effective_time": f"""
        SELECT trip_id, stop_sequence, source_timestamp,
            coalesce(stop_arrival_time, stop_departure_time) AS effective_stop_time,
            {_METHOD} AS effective_stop_time_calculation_method
        FROM updates""",
    "service_time": f"""
        SELECT trip_id, stop_sequence, start_date,
            {_scheduled("start_date", "arrival_time", "Australia/Melbourne")} AS scheduled_stop_time,
            {_scheduled("start_date", "departure_time", "UTC")} AS utc_departure_time
        FROM (
            SELECT *, DATE '2024-03-20' + CAST((ascii(right(trip_id, 1)) - 48) * 3 + stop_sequence % 3 AS INT) AS start_date
            FROM stop_times)""",
    "event_parts": f"""
        SELECT trip_id, stop_sequence, source_timestamp, source_timestamp AS event_ts, {_parts("source_timestamp")}
        FROM updates""",
    "delay_seconds": """
        SELECT trip_id, stop_sequence, source_timestamp, effective_stop_time, scheduled_stop_time, delay_seconds
        FROM flat_silver""",
    "feed_messages_trip": f"""
        SELECT mode, concat(trip_id, '-', stop_sequence) AS entity_id, source_timestamp,
            '2.0' AS gtfs_realtime_version, 0 AS incrementality, {_TRIP_FIELDS}, 0 AS schedule_relationship,
            CASE WHEN {_SECOND} THEN 2 ELSE 1 END AS stop_updates, stop_id AS first_stop_id,
            stop_arrival_time AS first_arrival,
            CASE WHEN {_SECOND} THEN stop_departure_time + 60 END AS second_departure
        FROM updates""",
    "feed_messages_vehicle": """
        SELECT mode, entity_id, source_timestamp, trip_id, route_id, '04:00:00' AS start_time,
            '20240101' AS start_date, concat('v', entity_id) AS vehicle_id, label, latitude, longitude,
            position_timestamp
        FROM positions""",
    "feed_union": """
        SELECT mode, source_timestamp, concat(trip_id, '-', stop_sequence) AS entity_id, 2 AS entities FROM updates""",
    "feed_roundtrip": f"""
        SELECT mode, concat(trip_id, '-', stop_sequence) AS entity_id, source_timestamp, trip_id,
            strftime(start_date, '%Y%m%d') AS start_date, CASE WHEN {_SECOND} THEN 2 ELSE 1 END AS stop_updates,
            stop_arrival_time AS first_arrival, stop_departure_time AS first_departure,
            CASE WHEN {_SECOND} THEN stop_sequence + 1000 END AS second_stop_sequence
        FROM updates""",
    "trip_explode": f"""
        WITH messages AS (
            SELECT *, concat(trip_id, '-', stop_sequence) AS entity_id FROM updates),
        stops AS (
            SELECT *, 0 AS schedule_relationship FROM messages
            UNION ALL
            SELECT * REPLACE (stop_sequence + 1000 AS stop_sequence, NULL AS stop_arrival_time,
                              stop_departure_time + 60 AS stop_departure_time), 1
            FROM messages WHERE {_SECOND})
        SELECT mode, '2.0' AS gtfs_realtime_version, source_timestamp, entity_id, {_TRIP_FIELDS},
            0 AS trip_schedule_relationship, stop_sequence, stop_id, stop_arrival_time, stop_departure_time,
            schedule_relationship
        FROM stops""",
    "feed_stream_vehicle": _SILVER_VEHICLES,
    "schedule_union": f"""
        SELECT trip_id, arrival_time, stop_sequence,
            CASE WHEN {_TRAM} THEN NULL ELSE departure_time END AS departure_time
        FROM stop_times""",
    "schedule_join": f"""
        SELECT u.trip_id, u.stop_sequence, u.source_timestamp, u.route_id, s.arrival_time,
            CASE WHEN {_TRAM.replace("trip_id", "u.trip_id")} THEN NULL ELSE s.departure_time END AS departure_time
        FROM updates u LEFT JOIN stop_times s ON u.trip_id = s.trip_id AND u.stop_sequence = s.stop_sequence""",
    "static_snapshot": """
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS trip_id, CAST(o_custkey % 50 AS VARCHAR) AS route_id,
            o_orderpriority AS trip_headsign, CAST(o_orderkey % 2 AS INTEGER) AS direction_id,
            NULL AS shape_id, 'bus' AS transport_mode, DATE '2024-01-01' AS valid_from,
            CAST(1704088800 AS BIGINT) AS ingested_at
        FROM orders
        UNION ALL
        SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0'), CAST(o_custkey % 50 AS VARCHAR), NULL,
            CAST(o_orderkey % 2 AS INTEGER), concat('shape ', o_custkey % 50), 'bus', DATE '2024-02-01', 1706767200
        FROM orders""",
    "latest_trips": "SELECT * FROM latest_trips",
    "latest_routes": "SELECT * FROM latest_routes",
    "latest_stops": "SELECT * FROM latest_stops",
    "silver_trip_updates": _SILVER_TRIPS,
    "silver_trip_updates_stream": _SILVER_TRIPS_STREAM,
    "silver_vehicle_positions": _SILVER_VEHICLES,
    "silver_vehicle_positions_stream": _SILVER_VEHICLES,
    "vehicle_enriched": f"""
        SELECT entity_id, trip_id, route_id, mode, position_timestamp, resolved_route_name, resolved_headsign
        FROM ({_NAMED})""",
    "live_delay": _LIVE_DELAY,
    "live_delay_stream": _LIVE_DELAY,
    "live_vehicle": _LIVE_VEHICLE,
    "live_vehicle_stream": _LIVE_VEHICLE,
    "live_vehicle_keyed": f"SELECT * EXCLUDE (expires_at) FROM ({_LIVE_VEHICLE})",
    "live_expiry_stream": _LIVE_EXPIRY,
    "dedup_latest": "SELECT * FROM deduped_all_ties",
    "incremental_dedup": "SELECT * FROM deduped_all_ties",
    "late_rows": "SELECT * FROM deduped_all_ties",
    "schema_growth_refresh": f"""
        SELECT {_KEYS}, source_timestamp,
               CASE WHEN source_timestamp > {SPLIT} AND stop_id IS NOT NULL THEN TRUE END AS noted
        FROM deduped_all_ties""",
    "high_water_mark": "SELECT max(source_timestamp) AS source_timestamp FROM flat_silver",
    "stored_mark": "SELECT max(source_timestamp) AS source_timestamp FROM flat_silver",
    "stop_hourly": _stop_hourly("deduped"),
    "late_refresh": _stop_hourly("deduped_all_ties"),
    "stop_hourly_refresh": _stop_hourly("deduped_all_ties"),
    "route_hourly": _route_hourly("deduped"),
    "route_hourly_refresh": _route_hourly("deduped_all_ties"),
    "schema_append": f"""
        WITH rows AS (
            SELECT * REPLACE (CASE WHEN source_timestamp > {SPLIT} THEN effective_stop_time_calculation_method END
                              AS effective_stop_time_calculation_method)
            FROM flat_silver)
        SELECT {_KEYS}, source_timestamp, effective_stop_time_calculation_method
        FROM ({_dedup("rows", _SHORT_TIES)})""",
}
_ORACLES["silver_closed_hours"] = _ORACLES["delay_seconds"]
_ORACLES["feed_stream_trip"] = _ORACLES["trip_explode"]


def oracles() -> dict[str, str]:
    """Each counterpart as one statement that defines the views it stands on."""
    views = ",\n".join(f"{name} AS ({text})" for name, text in _VIEWS.items())
    return {name: f"WITH {views}\nSELECT * FROM ({text})" for name, text in _ORACLES.items()}
