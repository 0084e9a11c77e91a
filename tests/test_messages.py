import json

from conftest import plan_of
from pyspark.sql import functions as F

from headway.operators.feeds import trip_update_messages, union_feeds, vehicle_messages
from headway.operators.messages import encode_value, flatten_trip_updates, flatten_vehicle_positions, parse_value
from headway.schemas import (
    FEED_SNAPSHOT,
    SILVER_TRIP_UPDATES,
    SILVER_VEHICLE_POSITIONS,
    TRIP_UPDATE_MESSAGE,
    VEHICLE_POSITION_MESSAGE,
    load_schema,
)


def trip_message(trip_id="t1", stops=(), **header):
    trip = {"trip_id": trip_id, "route_id": "r1", "start_time": "08:00:00", "start_date": "20240115"}
    return json.dumps(
        {
            "header": {"gtfs_realtime_version": "2.0", "incrementality": 0, "timestamp": 1705266309, **header},
            "entity_id": "e1",
            "mode": "bus",
            "trip_update": {"trip": trip, "stop_time_update": stops if stops is None else list(stops)},
        }
    )


def stop(sequence, arrival=None, departure=None):
    return {
        "stop_sequence": sequence,
        "arrival": arrival and {"time": arrival},
        "departure": departure and {"time": departure},
        "stop_id": f"s{sequence}",
        "schedule_relationship": 0,
    }


def records(rows, *texts):
    return rows([(bytearray(text, "utf-8"),) for text in texts], "value binary")


def test_trip_message_flattens_to_one_row_per_stop(rows):
    df = records(
        rows,
        trip_message(stops=[stop(1, 100, 120), stop(2, None, 220), stop(3)]),
        trip_message(stops=[]),
        trip_message(stops=None),
        trip_message(trip_id=None, stops=[stop(9, 1, 1)]),
        "{bad",
        "",
    )
    flat = flatten_trip_updates(parse_value(df, TRIP_UPDATE_MESSAGE))
    got = flat.select("trip_id", "stop_sequence", "stop_id", "stop_arrival_time", "stop_departure_time").collect()
    assert sorted(tuple(r) for r in got) == [
        ("t1", 1, "s1", 100, 120),
        ("t1", 2, "s2", None, 220),
        ("t1", 3, "s3", None, None),
    ]
    assert dict(flat.dtypes)["start_date"] == "string"


def test_json_is_parsed_once(spark, tmp_path):
    spark.range(3).select(F.lit("{}").cast("binary").alias("value")).write.parquet(str(tmp_path / "topic"))
    df = spark.read.parquet(str(tmp_path / "topic"))
    plan = plan_of(flatten_trip_updates(parse_value(df, TRIP_UPDATE_MESSAGE), typed_date=True))
    assert plan.count("from_json(") == 1


def test_unparsable_vehicle_messages_are_dropped(rows):
    good = {
        "mode": "tram",
        "header": {"gtfs_realtime_version": "2.0", "incrementality": 0, "timestamp": 1705266309},
        "entity_id": "e1",
        "vehicle": {
            "trip": {"trip_id": None, "route_id": "r", "start_time": "", "start_date": "20240115"},
            "vehicle": {"vehicle_id": "v", "label": "L"},
            "position": {"latitude": -37.5, "longitude": 145},
            "timestamp": 1705266300,
        },
    }
    flat = flatten_vehicle_positions(
        parse_value(records(rows, json.dumps(good), "{bad", "null"), VEHICLE_POSITION_MESSAGE)
    ).collect()
    assert len(flat) == 1
    assert (flat[0].trip_id, flat[0].latitude, flat[0].longitude, flat[0].position_timestamp) == (
        None,
        -37.5,
        145.0,
        1705266300,
    )


def test_snapshot_to_messages_and_back(spark):
    trip = {"trip_id": "t", "route_id": "", "start_time": "08:00:00", "start_date": "20240115"}
    update = {
        "trip": {**trip, "schedule_relationship": None},
        "stop_time_update": [
            {"stop_sequence": 1, "arrival": {"time": 0}, "departure": {"time": 50}, "stop_id": "s"},
            {"stop_sequence": None, "arrival": None, "departure": None, "stop_id": ""},
        ],
    }
    vehicle = {"trip": {**trip, "trip_id": ""}, "vehicle": {"id": "v", "label": "L"}, "position": None, "timestamp": 7}
    snapshot = {
        "header": {"gtfs_realtime_version": "2.0", "incrementality": None, "timestamp": 9},
        "entity": [
            {"id": "a", "vehicle": None, "trip_update": update},
            {"id": "b", "vehicle": vehicle, "trip_update": None},
            {"id": "c", "vehicle": None, "trip_update": None},
        ],
    }
    df = spark.createDataFrame([snapshot], FEED_SNAPSHOT)
    merged = union_feeds({"bus": df, "tram": df})

    messages = trip_update_messages(merged)
    assert sorted(r.mode for r in messages.collect()) == ["bus", "tram"]
    value = json.loads(encode_value(messages.filter("mode = 'bus'")).first().value.decode())
    assert value["header"] == {"gtfs_realtime_version": "2.0", "incrementality": 0, "timestamp": 9}
    assert value["trip_update"]["trip"]["route_id"] is None
    assert value["trip_update"]["trip"]["schedule_relationship"] == 0
    first, second = value["trip_update"]["stop_time_update"]
    assert first["arrival"] == {"time": None} and first["departure"] == {"time": 50}
    assert second == {
        "stop_sequence": 0, "arrival": None, "departure": None, "stop_id": None, "schedule_relationship": 0
    }

    vehicles = vehicle_messages(merged).filter("mode = 'tram'").collect()
    assert [v.entity_id for v in vehicles] == ["b"]
    record = vehicles[0].vehicle
    assert (record.trip.trip_id, record.vehicle.vehicle_id, record.position.latitude, record.timestamp) == (
        None, "v", 0.0, 7
    )
    parsed = parse_value(encode_value(messages), TRIP_UPDATE_MESSAGE).select("value.*")
    assert sorted(map(str, parsed.select(*messages.columns).collect())) == sorted(map(str, messages.collect()))


def test_schema_round_trips_through_json(tmp_path):
    path = tmp_path / "schema.json"
    path.write_text(TRIP_UPDATE_MESSAGE.json())
    assert load_schema(str(path)) == TRIP_UPDATE_MESSAGE


def test_declared_silver_schema_is_what_the_stream_writes(spark):
    from headway.plans.silver import service_schedule, silver_trip_updates, silver_vehicle_positions
    from headway.schemas import TOPIC_RECORD

    stop_times = spark.createDataFrame(
        [], "trip_id string, stop_sequence int, arrival_time string, departure_time string"
    )
    records = spark.createDataFrame([], TOPIC_RECORD)
    written = [
        (SILVER_TRIP_UPDATES, silver_trip_updates(records, service_schedule(stop_times), "Australia/Melbourne")),
        (SILVER_VEHICLE_POSITIONS, silver_vehicle_positions(records)),
    ]
    for declared, df in written:
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in declared]
