import itertools

from conftest import SF_DIR, plan_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from headway.operators.latest import latest_by
from headway.plans.marts import dedup_latest, hourly_counts, latest_version, route_hourly, stop_hourly
from headway.sinks.tables import read_mart, replace_mart
from workload import fixtures as fx

UPDATES = (
    "trip_id string, route_id string, stop_sequence int, mode string, stop_id string, source_timestamp bigint,"
    " delay_seconds bigint, year int, month int, day int, hour int"
)


def update(trip, ts, delay, route="r", sequence=1, mode="bus", stop="s", hour=5):
    return (trip, route, sequence, mode, stop, ts, delay, 2024, 1, 15, hour)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["a", "b", None]), st.integers(0, 3), st.one_of(st.none(), st.integers(0, 2))
        ),
        min_size=1,
        max_size=30,
    )
)
def test_latest_equals_brute_force(spark, data):
    df = spark.createDataFrame(data, "k string, ts int, v int").repartition(4)
    got = {(r.k, r.ts, r.v) for r in latest_by(df, ["k"], ["ts"]).collect()}
    ranked = sorted(data, key=lambda r: (str(r[0]), r[1], -1 if r[2] is None else r[2]))
    assert got == {list(group)[-1] for _, group in itertools.groupby(ranked, key=lambda r: str(r[0]))}


def test_a_hot_key_is_reduced_before_the_shuffle(spark, tmp_path):
    spark.range(100).selectExpr("0 AS k", "id AS ts").write.parquet(str(tmp_path / "t"))
    plan = plan_of(latest_by(spark.read.parquet(str(tmp_path / "t")), ["k"], ["ts"]))
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert "Final" in limits[0] and "Partial" in limits[1]
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_deduplication_after_a_join_still_reduces_first(spark, tmp_path):
    """The join is partitioned by some of the keys only; reusing that would leave a hot trip in one task."""
    keys = "CAST(id % 7 AS STRING) AS trip_id, 1 AS stop_sequence"
    rest = "'r' AS route_id, 'bus' AS mode, id AS source_timestamp, 2024 AS year, 1 AS month, 1 AS day, 1 AS hour"
    spark.range(100).selectExpr(*f"{keys}, {rest}".split(", ")).write.parquet(str(tmp_path / "u"))
    spark.range(7).selectExpr(*keys.split(", ")).write.parquet(str(tmp_path / "s"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.read.parquet(str(tmp_path / "u")).join(
            spark.read.parquet(str(tmp_path / "s")), ["trip_id", "stop_sequence"]
        )
        plan = plan_of(dedup_latest(joined))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("WindowGroupLimit") == 2 and "SortMergeJoin" in plan


def test_newest_prediction_per_stop_and_hour(rows):
    df = rows(
        [
            update("t", 10, 100),
            update("t", 20, 5),
            update("t", 20, 3),
            update("t", 15, 0, hour=6),
            update("t", 15, 7, route=None),
            update("t", 16, 8, route=None),
        ],
        UPDATES,
    )
    got = dedup_latest(df).collect()
    assert sorted((r.route_id or "", r.hour, r.source_timestamp, r.delay_seconds) for r in got) == [
        ("", 5, 16, 8),
        ("r", 5, 20, 5),
        ("r", 6, 15, 0),
    ]


def test_on_time_boundary_in_both_marts(spark, rows):
    delays = [-5, 0, 29, 30, None]
    deduped = rows([update("t", i, delay, sequence=i) for i, delay in enumerate(delays)], UPDATES)
    stops = rows([("s", "old", 1), ("s", "new", 2)], "stop_id string, stop_name string, ingested_at int")
    by_stop = stop_hourly(deduped, stops).collect()
    assert [(r.total_stops, r.on_time_stops, r.stop_name) for r in by_stop] == [(5, 3, "new")]
    trips = rows([("t", "r9", 1)], "trip_id string, route_id string, ingested_at int")
    routes = rows(
        [("r9", "9", "Nine", 1)], "route_id string, route_short_name string, route_long_name string, ingested_at int"
    )
    by_route = route_hourly(deduped, trips, routes).collect()
    assert [tuple(r) for r in by_route] == [("r9", "bus", 2024, 1, 15, 5, 5, 3, "9", "Nine")]


def test_trips_without_a_dimension_row_count_under_no_route(rows):
    deduped = rows([update("x", 1, 0), update("y", 1, 99)], UPDATES)
    trips = rows([], "trip_id string, route_id string, ingested_at int")
    routes = rows([], "route_id string, route_short_name string, route_long_name string, ingested_at int")
    got = route_hourly(deduped, trips, routes).collect()
    assert [(r.route_id, r.total_stops, r.on_time_stops, r.route_short_name) for r in got] == [(None, 2, 1, None)]


def test_ids_of_two_modes_can_be_kept_apart(rows):
    deduped = rows([update("t", 1, 0, mode="bus"), update("t", 1, 0, mode="tram")], UPDATES)
    stops = rows(
        [("s", "Bus stop", "bus", 1), ("s", "Tram stop", "tram", 2)],
        "stop_id string, stop_name string, transport_mode string, ingested_at int",
    )
    shared = {r.mode: r.stop_name for r in stop_hourly(deduped, stops).collect()}
    apart = {r.mode: r.stop_name for r in stop_hourly(deduped, stops, by_mode=True).collect()}
    assert shared == {"bus": "Tram stop", "tram": "Tram stop"}
    assert apart == {"bus": "Bus stop", "tram": "Tram stop"}


def test_skewed_marts_equal_brute_force(spark):
    """One trip and one stop hold a third of the rows."""
    raw = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 'hot', CAST(id % 97 AS STRING)) AS trip_id", "'r' AS route_id",
        "CAST(id % 11 AS INT) AS stop_sequence", "IF(id % 2 = 0, 'bus', 'tram') AS mode",
        "IF(id % 3 = 0, 'hot', CAST(id % 13 AS STRING)) AS stop_id", "id % 500 AS source_timestamp",
        "id * 7 % 61 AS delay_seconds", "2024 AS year", "1 AS month", "1 AS day", "CAST(id % 5 AS INT) AS hour",
    )
    best = {}
    for r in raw.collect():
        key = (r.trip_id, r.route_id, r.year, r.month, r.day, r.hour, r.stop_sequence)
        rank = (r.source_timestamp, r.mode, r.stop_id, r.delay_seconds)
        if key not in best or rank > best[key][0]:
            best[key] = (rank, r)
    expected = {}
    for _, r in best.values():
        total, good = expected.get((r.stop_id, r.mode, r.hour), (0, 0))
        expected[(r.stop_id, r.mode, r.hour)] = (total + 1, good + (r.delay_seconds < 30))
    stops = spark.createDataFrame([], "stop_id string, stop_name string, ingested_at int")
    deduped = dedup_latest(raw.repartition(8))
    got = {(r.stop_id, r.mode, r.hour): (r.total_stops, r.on_time_stops) for r in stop_hourly(deduped, stops).collect()}
    assert got == expected
    trips = spark.createDataFrame([("hot", "R", 1)], "trip_id string, route_id string, ingested_at int")
    routes = spark.createDataFrame(
        [], "route_id string, route_short_name string, route_long_name string, ingested_at int"
    )
    by_route = route_hourly(deduped, trips, routes).collect()
    assert sum(r.total_stops for r in by_route) == len(best)
    hot = sum(1 for _, r in best.values() if r.trip_id == "hot")
    assert sum(r.total_stops for r in by_route if r.route_id == "R") == hot


def test_latest_version_reads_only_what_it_needs(spark, tmp_path):
    spark.range(3).selectExpr("CAST(id AS STRING) AS trip_id", "'r' AS route_id", "'x' AS shape", "id AS ingested_at"
                              ).write.parquet(str(tmp_path / "d"))
    plan = plan_of(latest_version(spark.read.parquet(str(tmp_path / "d")), ["trip_id"], ["route_id"]))
    assert "shape" not in plan


def test_a_hot_trip_is_split_in_the_schedule_join(spark, tmp_path):
    """A third of all rows belongs to one stop of one trip; the join splits it, in a batch and in a stream."""
    from headway.plans.silver import delayed_stops, service_schedule

    update = (
        "IF(id % 3 = 0, 'hot', CAST(id % 5000 AS STRING)) AS trip_id,"
        " IF(id % 3 = 0, 1, CAST(id % 7 AS INT)) AS stop_sequence, DATE '2024-01-15' AS start_date,"
        " 1705266000 + id % 999 AS source_timestamp, 1705266000 + id AS stop_arrival_time,"
        " CAST(NULL AS BIGINT) AS stop_departure_time"
    )
    spark.range(0, 60000, 1, 8).createOrReplaceTempView("ids")
    spark.sql(f"SELECT {update} FROM ids").write.parquet(str(tmp_path / "updates"))
    scheduled = spark.sql("SELECT CAST(id AS STRING) AS trip_id FROM ids WHERE id < 5000").unionByName(
        spark.sql("SELECT 'hot' AS trip_id")
    )
    scheduled.selectExpr(
        "trip_id", "explode(sequence(0, 6)) AS stop_sequence", "'08:00:00' AS arrival_time", "'x' AS departure_time"
    ).write.parquet(str(tmp_path / "schedule"))
    updates, schedule = (spark.read.parquet(str(tmp_path / name)) for name in ("updates", "schedule"))
    schedule = service_schedule(schedule)
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
    }
    before = {key: spark.conf.get(key) for key in settings if key != "spark.sql.adaptive.autoBroadcastJoinThreshold"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        delayed = delayed_stops(updates, schedule, "Australia/Melbourne")
        joined = delayed.selectExpr("count(*)", "max(delay_seconds)", "max(event_ts)")
        assert joined.collect()[0][0] == 60000
        assert "skew=true" in plan_of(joined)
        stream = delayed_stops(spark.readStream.schema(updates.schema).parquet(str(tmp_path / "updates")), schedule, "UTC")
        query = (
            stream.writeStream.format("parquet")
            .option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True)
            .start(str(tmp_path / "out"))
        )
        query.awaitTermination()
        plan = query._jsq.explainInternal(False)
        assert spark.read.parquet(str(tmp_path / "out")).count() == 60000
        assert "skew=true" in plan
    finally:
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_mart_is_replaced_as_a_whole(spark, tmp_path):
    """Readers keep what they opened."""
    path, counts = str(tmp_path), hourly_counts(dedup_latest(fx.silver_updates(spark, SF_DIR)), "trip_id")
    replace_mart(counts, f"{path}/mart")
    opened = read_mart(spark, f"{path}/mart")
    replace_mart(counts.limit(0), f"{path}/mart")
    assert opened.count() == counts.count() and read_mart(spark, f"{path}/mart").count() == 0
