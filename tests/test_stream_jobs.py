import dataclasses
import json
import time

import pyarrow.parquet as pq
import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

from headway.__main__ import main
from headway.config import MODES, JobConfig
from headway.operators.live import DELAY_VIEW, VEHICLE_VIEW, live_view
from headway.plans.marts import dedup_latest, refresh_marts
from headway.plans.silver import named_positions, service_schedule, silver_trip_updates, silver_vehicle_positions
from headway.schemas import VEHICLE_POSITION_MESSAGE
from headway.sinks import tables
from headway.sinks.live import LiveChanges, LiveTable
from headway.sinks.tables import read_mart, read_table
from headway.sources.feeds import TRIP_UPDATES, VEHICLE_POSITIONS
from headway.sources.static import read_static
from headway.sources.topics import replay_topic
from headway.streaming import jobs, keyed_state
from headway.streaming.jobs import start_feed, start_trip_updates, start_vehicle_positions
from workload import fixtures as fx
from workload import queries
from workload.queries import _land, latest_routes, latest_stops, latest_trips, trip_records, vehicle_records, write_static

NOW = 1_712_000_000


def run(start, spark, config, topic):
    replay = replay_topic(spark, topic, max_files_per_trigger=2)
    started = start(spark, config, replay, {"availableNow": True}, lambda: NOW)
    for query in started:
        query.awaitTermination()
    return started


def config_at(spark, path, **sinks):
    static = write_static(spark, SF_DIR, f"{path}/static", "stop_times", "routes", "trips").static_path
    return JobConfig(
        static_path=static,
        timezone=fx.ZONE,
        lake_path=f"{path}/silver",
        live_path=f"{path}/live",
        checkpoint_path=f"{path}/checkpoint",
        **sinks,
    )


def test_both_sinks_resume_and_equal_the_batch(spark, tmp_path):
    config = config_at(spark, str(tmp_path), enable_live_sink=True, enable_silver_sink=True)
    records = trip_records(spark, SF_DIR).withColumn("half", F.pmod(F.hash("value"), F.lit(2)))
    topic = str(tmp_path / "topic")
    for half in (0, 1):
        records.filter(F.col("half") == half).select("value").write.mode("append").parquet(topic)
        started = run(start_trip_updates, spark, config, topic)
        assert len(started) == 1

    stop_times = spark.read.parquet(*config.static_paths("stop_times")[:2]).unionByName(
        spark.read.parquet(config.static_paths("stop_times")[2]), allowMissingColumns=True
    )
    expected = silver_trip_updates(trip_records(spark, SF_DIR), service_schedule(stop_times), fx.ZONE)
    silver = read_table(spark, config.silver_table(TRIP_UPDATES)).select(expected.columns)
    assert sorted(map(str, silver.collect())) == sorted(map(str, expected.collect()))

    live = LiveTable(spark, config.live_table(TRIP_UPDATES), DELAY_VIEW).read(NOW)
    assert sorted(map(str, live.collect())) == sorted(map(str, live_view(expected, DELAY_VIEW, NOW).collect()))

    for name, dimension in {"stops": fx.stops, "trips": fx.trips, "routes": fx.routes}.items():
        dimension(spark, SF_DIR).write.parquet(f"{tmp_path}/dims/{name}")
    refresh_marts(spark, config.silver_table(TRIP_UPDATES), f"{tmp_path}/dims", f"{tmp_path}/gold")
    deduped = read_table(spark, f"{tmp_path}/gold/trip_updates_deduped").select(expected.columns)
    assert sorted(map(str, deduped.collect())) == sorted(map(str, dedup_latest(expected).collect()))

    hours = {p.name for p in (tmp_path / "silver" / TRIP_UPDATES).glob("year=*/month=*/day=*/*")}
    assert hours == {"hour=0", "hour=1", "hour=2"}


def test_sinks_are_off_by_default(spark, tmp_path):
    config = config_at(spark, str(tmp_path))
    trip_records(spark, SF_DIR).write.parquet(str(tmp_path / "topic"))
    assert run(start_trip_updates, spark, config, str(tmp_path / "topic")) == []
    assert run(start_vehicle_positions, spark, config, str(tmp_path / "topic")) == []


def test_corrupt_records_do_not_stop_a_stream(spark, rows, tmp_path):
    config = config_at(spark, str(tmp_path), enable_live_sink=True, enable_silver_sink=True)
    topic = str(tmp_path / "topic")
    bad = [b"{bad", b"", b"null", b"[]", b'{"header": {"timestamp": 9000000000000000}, "vehicle": {"timestamp": "x"}}']
    rows([(bytearray(text),) for text in bad] + [(None,)], "value binary").write.parquet(topic)
    run(start_vehicle_positions, spark, config, topic)
    stored = read_table(spark, config.silver_table(VEHICLE_POSITIONS)).collect()
    assert [(r.source_timestamp, r.event_ts, r.year) for r in stored] == [(9000000000000000, None, None)]


def test_command_line_marts(spark, tmp_path, monkeypatch):
    for name, value in {"SILVER_PATH": f"{tmp_path}/silver", "STATIC_DATA_PATH": f"{tmp_path}/static"}.items():
        monkeypatch.setenv(name, value)
    fx.silver_updates(spark, SF_DIR).write.partitionBy("year", "month", "day", "hour").parquet(
        f"{tmp_path}/silver/{TRIP_UPDATES}"
    )
    dimensions = {"stops": fx.stops, "trips": fx.trips, "routes": fx.routes}
    for name, dimension in dimensions.items():
        dimension(spark, SF_DIR).write.parquet(f"{tmp_path}/dims/{name}")
    main(["marts", "--static", f"{tmp_path}/dims", "--target", f"{tmp_path}/gold"])
    totals = [
        read_mart(spark, f"{tmp_path}/gold/{mart}").agg(F.sum("total_stops"), F.sum("on_time_stops")).first()
        for mart in ("stop_hourly", "route_hourly")
    ]
    assert totals[0] == totals[1] and totals[0][0] == 4721


def test_static_command_feeds_the_streams_and_the_marts(spark, tmp_path, monkeypatch):
    """Published tables, landed snapshots, topics, both jobs and the marts, all below one folder."""
    base = str(tmp_path)
    source = tmp_path / "feed" / "4"
    source.mkdir(parents=True)
    tables = {
        "stop_times": (fx.stop_times, ["trip_id", "arrival_time", "departure_time", "stop_sequence"]),
        "trips": (latest_trips, ["route_id", "trip_id", "trip_headsign"]),
        "routes": (latest_routes, ["route_id", "route_short_name", "route_long_name"]),
        "stops": (latest_stops, ["stop_id", "stop_name"]),
    }
    for name, (build, columns) in tables.items():
        build(spark, SF_DIR).select(columns).toPandas().to_csv(source / f"{name}.txt", index=False)
    main(["static", "--source", f"{base}/feed", "--target", f"{base}/static", "--valid-from", "2024-01-01"])

    for topic, snapshots in {TRIP_UPDATES: fx.trip_snapshots, VEHICLE_POSITIONS: fx.vehicle_snapshots}.items():
        _land(snapshots(spark, SF_DIR), f"{base}/landed", topic)
    once = ["--checkpoint", f"{base}/published", "--recording", f"{base}/topics", "--once"]
    main(["publish", "--landed", f"{base}/landed", *once])

    env = {"STATIC_SNAPSHOT_PATH": f"{base}/static", "SILVER_PATH": f"{base}/silver", "CHECKPOINT_PATH": f"{base}/c"}
    config = JobConfig.from_env(env | {"ENABLE_SILVER_SINK": "1"})
    for start, topic in {start_trip_updates: TRIP_UPDATES, start_vehicle_positions: VEHICLE_POSITIONS}.items():
        run(start, spark, config, f"{base}/topics/{topic}")
    expected = fx.silver_updates(spark, SF_DIR).count()
    assert read_table(spark, config.silver_table(TRIP_UPDATES)).count() == expected > 0
    positions = read_table(spark, config.silver_table(VEHICLE_POSITIONS))
    assert positions.count() == fx.positions(spark, SF_DIR).count()

    monkeypatch.setenv("SILVER_PATH", f"{base}/silver")
    main(["marts", "--static", f"{base}/static", "--target", f"{base}/gold"])
    made = read_mart(spark, f"{base}/gold/route_hourly").agg(F.sum("total_stops")).first()[0]
    assert made == dedup_latest(fx.silver_updates(spark, SF_DIR)).count()


def test_a_published_stream_needs_a_checkpoint(spark, tmp_path):
    for mode in MODES:
        (tmp_path / mode / TRIP_UPDATES).mkdir(parents=True)
    with pytest.raises(ValueError, match="checkpoint"):
        start_feed(spark, TRIP_UPDATES, str(tmp_path), "", recording=str(tmp_path / "topic"))


def sorted_rows(df):
    return sorted(map(str, df.collect()))


def test_a_batch_is_parsed_and_joined_once(spark, tmp_path, monkeypatch):
    """Both sinks are written from one parsed micro-batch and one join; times of day were parsed before the stream started."""
    config = config_at(spark, str(tmp_path), enable_live_sink=True, enable_silver_sink=True)
    trip_records(spark, SF_DIR).repartition(4).write.parquet(str(tmp_path / "topic"))
    joins, plans = [], []
    join, append = jobs.delayed_stops, jobs.append_batch
    monkeypatch.setattr(jobs, "delayed_stops", lambda *a: joins.append(a) or join(*a))

    def seen(rows, *rest):
        append(rows, *rest)
        plans.append(rows._jdf.queryExecution().executedPlan().toString())

    monkeypatch.setattr(jobs, "append_batch", seen)
    run(start_trip_updates, spark, config, str(tmp_path / "topic"))
    assert len(joins) == len(plans) == 2
    for plan in plans:
        assert "InMemoryTableScan" in plan and "RLIKE" not in plan and "split(" not in plan
    stored = read_table(spark, config.silver_table(TRIP_UPDATES))
    assert stored.count() == fx.silver_updates(spark, SF_DIR).count()


def test_a_batch_that_was_lost_between_its_sinks_is_repeated(spark, tmp_path, monkeypatch):
    config = config_at(spark, str(tmp_path), enable_live_sink=True, enable_silver_sink=True)
    topic = str(tmp_path / "topic")
    trip_records(spark, SF_DIR).write.parquet(topic)
    for target, name in ((jobs.LiveTable, "upsert"), (tables, "rename")):
        with monkeypatch.context() as broken:
            broken.setattr(target, name, lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
            with pytest.raises(Exception, match="driver lost"):
                run(start_trip_updates, spark, config, topic)
        if name == "rename":
            break
        half = read_table(spark, config.silver_table(TRIP_UPDATES)).count()
        assert half > 0
        run(start_trip_updates, spark, config, topic)
        expected = fx.silver_updates(spark, SF_DIR)
        assert read_table(spark, config.silver_table(TRIP_UPDATES)).count() == expected.count()
        live = LiveTable(spark, config.live_table(TRIP_UPDATES), DELAY_VIEW).read(NOW)
        assert sorted_rows(live) == sorted_rows(live_view(expected, DELAY_VIEW, NOW))
        trip_records(spark, SF_DIR).limit(50).write.mode("append").parquet(topic)
    before = read_table(spark, config.silver_table(TRIP_UPDATES)).count()
    run(start_trip_updates, spark, config, topic)
    assert read_table(spark, config.silver_table(TRIP_UPDATES)).count() > before


def test_appending_a_batch_again_changes_nothing(spark, rows, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    hour = "id int, year int, month int, day int, hour int"
    batch = rows([(i, 2024, 1, 1, i % 3) for i in range(9)] + [(9, None, None, None, None)], hour)
    rename, moved = tables.rename, []

    def lost_after_two(*paths):
        if len(moved) == 2:
            raise RuntimeError("driver lost")
        moved.append(paths)
        rename(*paths)

    with monkeypatch.context() as broken:
        broken.setattr(tables, "rename", lost_after_two)
        with pytest.raises(RuntimeError):
            tables.append_batch(batch, path, 0, "q")
    for _ in range(3):
        tables.append_batch(batch, path, 0, "q")
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(10))
    tables.append_batch(rows([(10, 2024, 1, 1, 0)], hour), path, 1, "q")
    # Another stream numbers its batches anew.
    tables.append_batch(rows([(11, 2024, 1, 1, 0)], hour), path, 0, "p")
    assert sorted(r.id for r in read_table(spark, path).collect()) == list(range(12))
    assert [p.name for p in (tmp_path / "t_batches").iterdir()] == ["p-0"]


def test_the_schedule_is_reduced_to_the_batch(spark, tmp_path, monkeypatch):
    config = config_at(spark, str(tmp_path), enable_silver_sink=True)
    trip_records(spark, SF_DIR).limit(20).write.parquet(str(tmp_path / "topic"))
    met = []
    join = jobs.delayed_stops
    monkeypatch.setattr(jobs, "delayed_stops", lambda stops, needed, zone: met.append(needed.count()) or join(stops, needed, zone))
    run(start_trip_updates, spark, config, str(tmp_path / "topic"))
    assert 0 < sum(met) < 60 < spark.read.parquet(*config.static_paths("stop_times")[:1]).count()


def test_the_trigger_makes_batches_as_time_passes(spark, tmp_path):
    config = config_at(spark, str(tmp_path), enable_silver_sink=True)
    config = dataclasses.replace(config, silver_trigger="1 second")
    topic = str(tmp_path / "topic")
    records = vehicle_records(spark, SF_DIR)
    records.limit(10).write.parquet(topic)
    (query,) = start_vehicle_positions(spark, config, replay_topic(spark, topic))
    try:
        stored = config.silver_table(VEHICLE_POSITIONS)
        for total in (10, 20):
            until = time.time() + 60
            while time.time() < until and not (tmp_path / "silver" / VEHICLE_POSITIONS).exists():
                time.sleep(0.2)
            while time.time() < until and read_table(spark, stored).count() < total:
                time.sleep(0.2)
            assert read_table(spark, stored).count() == total
            records.limit(10).write.mode("append").parquet(topic)
        assert query.lastProgress["batchId"] >= 1
    finally:
        query.stop()


def keyed(config, **other):
    return dataclasses.replace(config, keyed_live_state=True, **other)


def test_keyed_state_equals_the_rewritten_view(spark, tmp_path):
    """Both forms of the live vehicle view agree, also after a restart from the checkpoint."""
    config = config_at(spark, str(tmp_path), enable_live_sink=True, enable_silver_sink=True)
    in_state = keyed(config, live_path=f"{tmp_path}/k", checkpoint_path=f"{tmp_path}/kc", live_ttl_seconds=3600, lake_path=f"{tmp_path}/ks")
    topic = str(tmp_path / "topic")
    records = vehicle_records(spark, SF_DIR).withColumn("half", F.pmod(F.hash("value"), F.lit(2)))
    for half in (0, 1):
        records.filter(F.col("half") == half).select("value").write.mode("append").parquet(topic)
        assert len(run(start_vehicle_positions, spark, in_state, topic)) == 2
    run(start_vehicle_positions, spark, config, topic)
    rewritten = LiveTable(spark, config.live_table(VEHICLE_POSITIONS), VEHICLE_VIEW).read(NOW).drop("expires_at")
    view = dataclasses.replace(VEHICLE_VIEW, ttl_seconds=3600)
    changes = LiveChanges(spark, in_state.live_table(VEHICLE_POSITIONS), view)
    assert sorted_rows(changes.read().drop("expires_at").select(rewritten.columns)) == sorted_rows(rewritten)
    assert rewritten.count() > 0 and changes.read(int(time.time()) + 3601).count() == 0
    silver = [read_table(spark, c.silver_table(VEHICLE_POSITIONS)).count() for c in (config, in_state)]
    assert silver[0] == silver[1] == fx.positions(spark, SF_DIR).count()


def test_keyed_state_renews_and_forgets(spark, rows, tmp_path):
    """An older row renews a lifetime without replacing newer fields; after it has passed, an older row counts again."""
    for key, value in keyed_state.STATE_SETTINGS.items():
        spark.conf.set(key, value)
    view = dataclasses.replace(DELAY_VIEW, ttl_seconds=25)  # longer than a batch takes on a busy machine
    schema = "trip_id string, source_timestamp bigint, stop_sequence int, delay_seconds bigint"
    landed, seen = str(tmp_path / "in"), []

    def land(*data):
        rows(list(data), schema).coalesce(1).write.mode("append").parquet(landed)
        stream = spark.readStream.schema(schema).parquet(landed)
        query = keyed_state.keyed_entries(stream, view).writeStream.outputMode("update").trigger(availableNow=True)
        query = query.option("checkpointLocation", str(tmp_path / "c"))
        query.foreachBatch(lambda batch, number: seen.append(batch.select("key", "fields.*", "expires_at").collect())).start().awaitTermination()
        return {r.key: (r.last_stop_sequence, r.delay_seconds) for r in seen[-1]}

    assert land(("t", 10, 1, 5), ("t", 10, 2, None), ("u", None, 1, 1), (None, 1, 1, 1)) == {
        "delay:trip:t": (2, None), "delay:trip:u": (1, 1),
    }
    first = seen[-1][0].expires_at
    assert land(("t", 8, 3, 6)) == {"delay:trip:t": (2, None)}
    assert seen[-1][0].expires_at >= first
    time.sleep(26)
    assert land(("t", 8, 3, 6)) == {"delay:trip:t": (3, 6)}


def test_a_message_schema_from_a_file(spark, tmp_path):
    """A job reads the schema it is given; fields that it lacks are not parsed."""
    config = config_at(spark, str(tmp_path), enable_silver_sink=True)
    schema = VEHICLE_POSITION_MESSAGE.jsonValue()
    (tmp_path / "schemas").mkdir()
    text = json.dumps(schema).replace('"label"', '"no_label"', 1)
    (tmp_path / "schemas" / f"{VEHICLE_POSITIONS}.json").write_text(json.dumps(schema))
    vehicle_records(spark, SF_DIR).write.parquet(str(tmp_path / "topic"))
    run(start_vehicle_positions, spark, dataclasses.replace(config, schema_path=f"{tmp_path}/schemas"), str(tmp_path / "topic"))
    stored = read_table(spark, config.silver_table(VEHICLE_POSITIONS))
    assert stored.count() == fx.positions(spark, SF_DIR).count()
    (tmp_path / "schemas" / f"{VEHICLE_POSITIONS}.json").write_text(text)
    with pytest.raises(Exception, match="label"):
        run(start_vehicle_positions, spark, dataclasses.replace(config, schema_path=f"{tmp_path}/schemas"), str(tmp_path / "topic"))


def test_keyed_state_takes_rows_and_not_a_frame_for_each_key(spark):
    rows = spark.readStream.format("rate").load().selectExpr(
        "CAST(value AS STRING) AS trip_id", "value AS source_timestamp", "1 AS stop_sequence", "value AS delay_seconds"
    )
    plan = keyed_state.keyed_entries(rows, DELAY_VIEW)._jdf.queryExecution().analyzed().toString()
    assert "TransformWithStateInPySpark" in plan and "InPandas" not in plan.replace("MapInPandas", "")


def test_the_batches_of_a_job_follow_the_cores_and_not_its_topic(spark, tmp_path, monkeypatch):
    """With parts as small beside this topic as the default ones are beside a large one."""
    small = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    }
    before = {key: spark.conf.get(key) for key in small}
    seen, paths, append, replay = [], [], jobs.append_batch, queries.replay_topic
    monkeypatch.setattr(queries, "ROW_GROUP", 16 << 10, raising=False)
    monkeypatch.setattr(jobs, "append_batch", lambda rows, path, number, *rest: seen.append(number) or append(rows, path, number, *rest))
    monkeypatch.setattr(queries, "replay_topic", lambda spark, path, **more: paths.append(path) or replay(spark, path, **more))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        stored = queries.all_queries()["silver_trip_updates_stream"](spark, SF_DIR)
        assert {key: spark.conf.get(key) for key in small} == small
        assert stored.count() == fx.silver_updates(spark, SF_DIR).count()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert 1 <= len(seen) <= 2
    files = [file.removeprefix("file://") for file in spark.read.parquet(paths[0]).inputFiles()]
    assert max(pq.ParquetFile(file).num_row_groups for file in files) > 1


def test_a_batch_is_kept_before_it_is_used(spark, tmp_path, monkeypatch):
    """Uses that start at once would each occupy tasks with the same parsing."""
    config = config_at(spark, str(tmp_path), enable_silver_sink=True)
    trip_records(spark, SF_DIR).repartition(2).write.parquet(str(tmp_path / "topic"))
    join, kept = jobs.delayed_stops, []

    def seen(*given):
        kept.append([(i.numCachedPartitions(), i.numPartitions()) for i in spark._jsc.sc().getRDDStorageInfo()])
        return join(*given)

    monkeypatch.setattr(jobs, "delayed_stops", seen)
    run(start_trip_updates, spark, config, str(tmp_path / "topic"))
    assert len(kept) == 1 and any(done == parts > 0 for done, parts in kept[0])


def test_the_live_view_looks_up_its_own_trips_once(spark, rows, tmp_path, monkeypatch):
    """Names are looked up for the newest row of each trip, among the trips of the batch; repeated ids change nothing."""
    config = config_at(spark, str(tmp_path), enable_live_sink=True)
    rows([("1", "a"), ("1", "z"), (None, "n")], "trip_id string, trip_headsign string").write.mode("append").parquet(
        f"{config.static_path}/bus/trips"
    )
    rows([("1", "0", None)] * 2 + [("1", "Z", "l")], "route_id string, route_short_name string, route_long_name string").write.mode(
        "append"
    ).parquet(f"{config.static_path}/bus/routes")
    records = vehicle_records(spark, SF_DIR)
    records.unionAll(records.limit(30)).write.parquet(str(tmp_path / "topic"))
    met = []

    def seen(positions, routes, trips):
        met.append((positions.count(), positions.select("trip_id").distinct().count(), trips.count()))
        return named_positions(positions, routes, trips)

    monkeypatch.setattr(jobs, "named_positions", seen)
    run(start_vehicle_positions, spark, config, str(tmp_path / "topic"))
    routes, trips = (read_static(spark, config.static_paths(name)) for name in ("routes", "trips"))
    expected = live_view(named_positions(silver_vehicle_positions(records), routes, trips), VEHICLE_VIEW, NOW)
    assert sorted_rows(LiveTable(spark, config.live_table(VEHICLE_POSITIONS), VEHICLE_VIEW).read(NOW)) == sorted_rows(expected)
    assert met and all(rows == keys and looked_up < trips.count() / 4 for rows, keys, looked_up in met)
