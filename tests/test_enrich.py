import datetime as dt

import pytest
from conftest import plan_of

from headway.operators.enrich import join_schedule, join_static, with_effective_time, with_resolved_names
from headway.plans.silver import delayed_stops, service_schedule
from headway.sources.static import union_static

ZONE = "Australia/Melbourne"
DAY = dt.date(2024, 1, 15)
STOPS = (
    "trip_id string, start_date date, stop_sequence int, source_timestamp bigint,"
    " stop_arrival_time bigint, stop_departure_time bigint"
)
STOP_TIMES = "trip_id string, stop_sequence int, arrival_time string, departure_time string"


def test_effective_time_and_its_origin(rows):
    df = with_effective_time(
        rows([(1, 2), (None, 2), (1, None), (None, None)], "stop_arrival_time bigint, stop_departure_time bigint")
    )
    got = df.select("effective_stop_time", "effective_stop_time_calculation_method").collect()
    assert [tuple(r) for r in got] == [(1, "arrival"), (2, "departure"), (1, "arrival"), (None, None)]


def test_only_rows_with_both_times_get_a_delay(rows):
    at = 1705266309
    stops = rows(
        [
            ("late", DAY, 1, at, at + 90, None),
            ("late", DAY, 2, at, None, at),
            ("no time", DAY, 1, at, None, None),
            ("no date", None, 1, at, at, None),
            ("no schedule", DAY, 1, at, at, None),
            ("bad schedule", DAY, 1, at, at, None),
            ("absurd", DAY, 1, at, -(2**63), None),
        ],
        STOPS,
    )
    times = [(t, 1, "08:05:09", None) for t in ("late", "no time", "no date", "absurd")]
    times += [("late", 2, "08:05:10", "08:06:00"), ("bad schedule", 1, "08:05", None)]
    got = delayed_stops(stops, service_schedule(rows(times, STOP_TIMES)), ZONE)
    assert sorted((r.trip_id, r.stop_sequence, r.scheduled_stop_time, r.delay_seconds) for r in got.collect()) == [
        ("absurd", 1, at, None),
        ("late", 1, at, 90),
        ("late", 2, at + 1, -1),
    ]
    assert "Inner" in plan_of(got) and "LeftOuter" not in plan_of(got)


def test_duplicate_schedule_rows_multiply_realtime_rows(rows):
    stops = rows([("t", DAY, 1, 0, 5, None)], STOPS)
    times = rows([("t", 1, "08:00:00", "a"), ("t", 1, "08:00:00", "b")], STOP_TIMES)
    assert delayed_stops(stops, service_schedule(times), ZONE).count() == 2


def test_static_join_keeps_realtime_rows_and_columns(rows):
    realtime = rows([("r1", "x"), ("r2", "y"), (None, "z")], "route_id string, name string")
    static = rows([("r1", "other", "short"), (None, "other", "null")], "route_id string, name string, extra string")
    got = join_static(realtime, static, ["route_id"], suffix="_static")
    assert got.columns == ["route_id", "name", "name_static", "extra"]
    assert sorted((r.name, r.name_static, r.extra) for r in got.collect()) == [
        ("x", "other", "short"),
        ("y", None, None),
        ("z", None, None),
    ]
    with pytest.raises(ValueError, match="name"):
        join_static(realtime, static, ["route_id"])


def test_modes_with_different_id_types_are_united(rows):
    numbers = rows([(1, "7", 2)], "trip_id bigint, stop_sequence string, direction_id int")
    texts = rows([("A-1", 3), (None, None)], "trip_id string, stop_sequence int")
    got = union_static([numbers, texts], ["trip_id", "stop_sequence"])
    assert dict(got.dtypes) == {"trip_id": "string", "stop_sequence": "int"}
    assert {tuple(r) for r in got.collect()} == {("1", 7), ("A-1", 3), (None, None)}


def test_schedule_directories_are_pruned_and_united(spark, rows, tmp_path):
    rows([("a", 1, "08:00:00", "08:00:20", "x")], STOP_TIMES + ", pickup string").write.parquet(str(tmp_path / "bus"))
    rows([("b", 1, "09:00:00")], "trip_id string, stop_sequence int, arrival_time string").write.parquet(
        str(tmp_path / "tram")
    )
    realtime = rows([("a", 1), ("b", 1), ("c", 1)], "trip_id string, stop_sequence int")
    paths = [str(tmp_path / "bus"), str(tmp_path / "tram")]
    columns = ["trip_id", "arrival_time", "departure_time", "stop_sequence"]
    got = join_schedule(spark, realtime, paths, ["trip_id", "stop_sequence"], columns)
    assert sorted(tuple(r) for r in got.collect()) == [
        ("a", 1, "08:00:00", "08:00:20"),
        ("b", 1, "09:00:00", None),
        ("c", 1, None, None),
    ]
    assert "pickup" not in plan_of(got)


def test_union_rejects_a_column_nobody_has(rows):
    with pytest.raises(ValueError, match="nope"):
        union_static([rows([("a",)], "trip_id string")], ["trip_id", "nope"])


def test_name_fallbacks(rows):
    df = rows(
        [("S", "L", "r", "h"), (None, "L", "r", None), (None, None, "r", "h"), (None, None, None, None)],
        "route_short_name string, route_long_name string, route_id string, trip_headsign string",
    )
    got = with_resolved_names(df).select("resolved_route_name", "resolved_headsign").collect()
    assert [tuple(r) for r in got] == [
        ("S", "h"), ("L", "UNKNOWN_DESTINATION"), ("r", "h"), ("UNKNOWN_ROUTE", "UNKNOWN_DESTINATION")
    ]
