"""Registered queries. Each takes ``(spark, sf_dir)``, reads whole tables and returns a DataFrame."""

from __future__ import annotations

import contextlib
import datetime as dt
import functools
from collections.abc import Callable, Iterator

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.config import MODES, JobConfig
from headway.functions import local_epoch, service_date, service_seconds, with_event_parts
from headway.operators.enrich import join_schedule, with_effective_time
from headway.operators.incremental import UpsertSpec, footer_scan, hour_folders, max_mark, upsert_latest
from headway.operators.live import DELAY_VIEW, VEHICLE_VIEW, live_view
from headway.operators.messages import encode_value, flatten_trip_updates, parse_value
from headway.plans import marts, silver
from headway.plans.silver import STOP_TIME_COLUMNS, STOP_TIME_KEYS, named_positions
from headway.schemas import SILVER_TRIP_UPDATES, SILVER_VEHICLE_POSITIONS, TRIP_UPDATE_MESSAGE, VEHICLE_POSITION_MESSAGE
from headway.session import SHUFFLES_GO, configure, fresh_dir, set_for_now
from headway.sinks.closed import close_hours, read_silver
from headway.sinks.live import LiveChanges, LiveTable
from headway.sinks.tables import append_silver, read_mart, read_table
from headway.sources.feeds import TRIP_UPDATES, VEHICLE_POSITIONS, feed_messages, read_feeds
from headway.sources.static import append_snapshot, load_published_tables, read_snapshots, read_static
from headway.sources.topics import recorded_topic, replay_topic
from headway.storage import delete, move
from headway.streaming.jobs import start_feed, start_trip_updates, start_vehicle_positions
from workload import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]

# The clock of the live views, and the point in the data at which incremental runs are split.
NOW = 1_712_000_000
SPLIT = (19802 + 15) * 86400 + 5400

# Decides between predictions of equal age; short, so that unused columns stay pruned.
TIES = ("stop_id", "mode", "delay_seconds")

_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    """Register a query under its function name."""

    def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
        return run(configure(spark), sf_dir)

    _QUERIES[run.__name__] = configured
    return run


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _epoch(df: DataFrame, name: str) -> DataFrame:
    """Show an instant as epoch seconds, which no session time zone can alter."""
    return df.withColumn(name, F.unix_seconds(name))


# --- Scalar semantics


@query
def parse_message(spark, sf_dir):
    records = fx.table(spark, sf_dir, "events").select(F.col("props").cast("binary").alias("value"))
    return parse_value(records, "k INT").select("value.k")


@query
def effective_time(spark, sf_dir):
    timed = with_effective_time(fx.updates(spark, sf_dir))
    return timed.select(
        "trip_id",
        "stop_sequence",
        "source_timestamp",
        "effective_stop_time",
        "effective_stop_time_calculation_method",
    )


@query
def service_time(spark, sf_dir):
    dated = fx.stop_times(spark, sf_dir).withColumn(
        "start_date",
        F.expr(
            "date_format(DATE '2024-03-20' + (ascii(right(trip_id, 1)) - 48) * 3 + stop_sequence % 3, 'yyyyMMdd')"
        ),
    )
    typed = dated.withColumn("start_date", service_date("start_date")).withColumns(
        {"arrival": service_seconds("arrival_time"), "departure": service_seconds("departure_time")}
    )
    return typed.select(
        "trip_id",
        "stop_sequence",
        "start_date",
        local_epoch("start_date", "arrival", fx.ZONE).alias("scheduled_stop_time"),
        local_epoch("start_date", "departure", "UTC").alias("utc_departure_time"),
    )


@query
def event_parts(spark, sf_dir):
    parts = with_event_parts(fx.updates(spark, sf_dir).select("trip_id", "stop_sequence", "source_timestamp"))
    return _epoch(parts, "event_ts")


@query
def delay_seconds(spark, sf_dir):
    return fx.silver_updates(spark, sf_dir).select(
        "trip_id", "stop_sequence", "source_timestamp", "effective_stop_time", "scheduled_stop_time", "delay_seconds"
    )


# --- Feeds and messages


def trip_records(spark, sf_dir) -> DataFrame:
    return encode_value(feed_messages(fx.trip_snapshots(spark, sf_dir), TRIP_UPDATES))


def vehicle_records(spark, sf_dir) -> DataFrame:
    return encode_value(feed_messages(fx.vehicle_snapshots(spark, sf_dir), VEHICLE_POSITIONS))


@query
def feed_messages_trip(spark, sf_dir):
    messages = feed_messages(fx.trip_snapshots(spark, sf_dir), TRIP_UPDATES)
    stops = "trip_update.stop_time_update"
    return messages.select(
        "mode",
        "entity_id",
        F.col("header.timestamp").alias("source_timestamp"),
        "header.gtfs_realtime_version",
        "header.incrementality",
        "trip_update.trip.*",
        F.size(stops).alias("stop_updates"),
        F.get(stops, F.lit(0))["stop_id"].alias("first_stop_id"),
        F.get(stops, F.lit(0))["arrival"]["time"].alias("first_arrival"),
        F.get(stops, F.lit(1))["departure"]["time"].alias("second_departure"),
    )


@query
def feed_messages_vehicle(spark, sf_dir):
    messages = feed_messages(fx.vehicle_snapshots(spark, sf_dir), VEHICLE_POSITIONS)
    return messages.select(
        "mode",
        "entity_id",
        F.col("header.timestamp").alias("source_timestamp"),
        "vehicle.trip.*",
        "vehicle.vehicle.*",
        "vehicle.position.*",
        F.col("vehicle.timestamp").alias("position_timestamp"),
    )


# How many files of a partitioned write a task holds open, before it sorts the rows by their folder instead.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"


def _write_modes(df: DataFrame, base: str, name: str, modes=MODES) -> None:
    """``{base}/{mode}/{name}`` for each value of the column ``mode``, in one pass over ``df``.

    A task has a file open for each mode. Sorting by mode would keep all its rows in memory, whole messages among them.
    """
    with set_for_now(df.sparkSession, {OPEN_FILES: str(len(MODES))}):
        df.write.partitionBy("mode").parquet(f"{base}/{name}_modes")
    for mode in modes:
        move(df.sparkSession, f"{base}/{name}_modes/mode={mode}", f"{base}/{mode}/{name}")


def _land(snapshots: DataFrame, base: str, topic: str) -> None:
    _write_modes(snapshots, base, topic)


@query
def feed_union(spark, sf_dir):
    base = fresh_dir(spark, "feeds")
    _land(fx.trip_snapshots(spark, sf_dir), base, TRIP_UPDATES)
    merged = read_feeds(spark, base, TRIP_UPDATES)
    return merged.select(
        "mode",
        F.col("header.timestamp").alias("source_timestamp"),
        F.get("entity", F.lit(0))["id"].alias("entity_id"),
        F.size("entity").alias("entities"),
    )


def _published(spark, snapshots: DataFrame, topic: str) -> DataFrame:
    """Land the snapshots of every mode, run the publishing job over them, and read the topic it fills."""
    base = fresh_dir(spark, "publish")
    _land(snapshots, f"{base}/landed", topic)
    job = start_feed(
        spark, topic, f"{base}/landed", f"{base}/checkpoint", recording=f"{base}/topic", trigger={"availableNow": True}
    )
    job.awaitTermination()
    return recorded_topic(spark, f"{base}/topic")


@query
def feed_stream_trip(spark, sf_dir):
    published = _published(spark, fx.trip_snapshots(spark, sf_dir), TRIP_UPDATES)
    return flatten_trip_updates(parse_value(published, TRIP_UPDATE_MESSAGE))


@query
def feed_stream_vehicle(spark, sf_dir):
    published = _published(spark, fx.vehicle_snapshots(spark, sf_dir), VEHICLE_POSITIONS)
    return _epoch(silver.silver_vehicle_positions(published), "event_ts")


@query
def feed_roundtrip(spark, sf_dir):
    stops = "value.trip_update.stop_time_update"
    return parse_value(trip_records(spark, sf_dir), TRIP_UPDATE_MESSAGE).select(
        "value.mode",
        "value.entity_id",
        F.col("value.header.timestamp").alias("source_timestamp"),
        "value.trip_update.trip.trip_id",
        "value.trip_update.trip.start_date",
        F.size(stops).alias("stop_updates"),
        F.get(stops, F.lit(0))["arrival"]["time"].alias("first_arrival"),
        F.get(stops, F.lit(0))["departure"]["time"].alias("first_departure"),
        F.get(stops, F.lit(1))["stop_sequence"].alias("second_stop_sequence"),
    )


@query
def trip_explode(spark, sf_dir):
    return flatten_trip_updates(parse_value(trip_records(spark, sf_dir), TRIP_UPDATE_MESSAGE))


# --- Static data


def write_static(spark, sf_dir, base: str, *names: str) -> JobConfig:
    """Per-mode directories of the named schedule tables; the tram ones have no departure_time."""
    tables = {
        "stop_times": ("trip_id", fx.stop_times),
        "routes": ("route_id", latest_routes),
        "trips": ("trip_id", latest_trips),
    }
    for name in names:
        key, build = tables[name]
        table = build(spark, sf_dir)
        names = F.array(*map(F.lit, MODES))
        table = table.withColumn("mode", F.get(names, F.expr(f"ascii(right({key}, 1)) % {len(MODES)}")))
        if "departure_time" in table.columns:
            bare = table.filter("mode = 'tram'").drop("departure_time", "mode")
            bare.write.parquet(f"{base}/tram/{name}")
            _write_modes(table.filter("mode != 'tram'"), base, name, [mode for mode in MODES if mode != "tram"])
        else:
            _write_modes(table, base, name)
    return JobConfig(static_path=base, timezone=fx.ZONE)


@query
def schedule_union(spark, sf_dir):
    config = write_static(spark, sf_dir, fresh_dir(spark, "static"), "stop_times")
    return read_static(spark, config.static_paths("stop_times"), STOP_TIME_COLUMNS)


@query
def schedule_join(spark, sf_dir):
    config = write_static(spark, sf_dir, fresh_dir(spark, "static"), "stop_times")
    updates = fx.updates(spark, sf_dir).select("trip_id", "stop_sequence", "source_timestamp", "route_id")
    return join_schedule(spark, updates, config.static_paths("stop_times"), STOP_TIME_KEYS, STOP_TIME_COLUMNS)


@query
def static_snapshot(spark, sf_dir):
    base = fresh_dir(spark, "published")
    orders = fx.table(spark, sf_dir, "orders").selectExpr(
        "lpad(CAST(o_orderkey AS STRING), 12, '0') AS trip_id",
        "CAST(o_custkey % 50 AS STRING) AS route_id",
        "o_orderpriority AS trip_headsign",
        "CAST(o_orderkey % 2 AS STRING) AS direction_id",
    )
    # The second publication has its columns in another order and one more of them.
    second = orders.selectExpr("direction_id", "trip_id", "concat('shape ', route_id) AS shape_id", "route_id")
    for name, table in {"first": orders, "second": second}.items():
        table.write.option("header", True).csv(f"{base}/{name}/4/trips.txt")
    for name, day in {"first": "2024-01-01", "second": "2024-02-01"}.items():
        clock = dt.datetime.fromisoformat(f"{day}T06:00:00+00:00")
        load_published_tables(spark, f"{base}/{name}", f"{base}/lake", day, ingested_at=clock)
    return _epoch(read_snapshots(spark, f"{base}/lake/trips"), "ingested_at")


@query
def latest_trips(spark, sf_dir):
    return marts.latest_version(fx.trips(spark, sf_dir), ["trip_id"], ["route_id", "trip_headsign"])


@query
def latest_routes(spark, sf_dir):
    return marts.latest_version(fx.routes(spark, sf_dir), ["route_id"], ["route_short_name", "route_long_name"])


@query
def latest_stops(spark, sf_dir):
    return marts.latest_version(fx.stops(spark, sf_dir), ["stop_id"], ["stop_name"])


# --- Silver tables, as a batch and as a stream


def _batch_trip_updates(spark, sf_dir) -> DataFrame:
    schedule = silver.service_schedule(fx.stop_times(spark, sf_dir))
    return silver.silver_trip_updates(trip_records(spark, sf_dir), schedule, fx.ZONE)


@query
def silver_trip_updates(spark, sf_dir):
    return _epoch(_batch_trip_updates(spark, sf_dir), "event_ts")


@query
def silver_vehicle_positions(spark, sf_dir):
    return _epoch(silver.silver_vehicle_positions(vehicle_records(spark, sf_dir)), "event_ts")


def _named_positions(spark, sf_dir) -> DataFrame:
    positions = silver.silver_vehicle_positions(vehicle_records(spark, sf_dir))
    return named_positions(positions, latest_routes(spark, sf_dir), latest_trips(spark, sf_dir))


@query
def vehicle_enriched(spark, sf_dir):
    return _named_positions(spark, sf_dir).select(
        "entity_id", "trip_id", "route_id", "mode", "position_timestamp", "resolved_route_name", "resolved_headsign"
    )


# For each topic: how to start its job, how to record it, and the schedule tables the job reads.
_JOBS = {
    TRIP_UPDATES: (start_trip_updates, trip_records, ["stop_times"]),
    VEHICLE_POSITIONS: (start_vehicle_positions, vehicle_records, ["routes", "trips"]),
}


# A recorded topic has a part for each core, up to this size, as a topic has partitions: with parts of a fixed small size
# a stream over them would have batches in proportion to the input, each of which reads all static tables.
TOPIC_PARTS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
}
# Bytes of a row group, which one task reads. With Parquet's own 128 MB a batch of few files would leave most cores idle.
ROW_GROUP = 4 << 20


def _record(records: DataFrame, path: str) -> None:
    """Topic files that a stream reads in few batches, each with all cores."""
    with set_for_now(records.sparkSession, TOPIC_PARTS):
        records.write.option("parquet.block.size", ROW_GROUP).parquet(path)


def _run_job(topic: str, spark, sf_dir, **sinks) -> JobConfig:
    """Record a topic, run its streaming job over it until it has caught up, and return the configuration."""
    start, records, static = _JOBS[topic]
    base = fresh_dir(spark, "job")
    write_static(spark, sf_dir, f"{base}/static", *static)
    config = JobConfig(
        static_path=f"{base}/static",
        timezone=fx.ZONE,
        lake_path=f"{base}/silver",
        live_path=f"{base}/live",
        checkpoint_path=f"{base}/checkpoint",
        **sinks,
    )
    _record(records(spark, sf_dir), f"{base}/topic")
    replay = replay_topic(spark, f"{base}/topic", max_files_per_trigger=4)
    for running in start(spark, config, replay, {"availableNow": True}, lambda: NOW):
        running.awaitTermination()
    return config


@query
def silver_trip_updates_stream(spark, sf_dir):
    config = _run_job(TRIP_UPDATES, spark, sf_dir, enable_silver_sink=True)
    stored = read_table(spark, config.silver_table(TRIP_UPDATES), schema=SILVER_TRIP_UPDATES)
    return _epoch(stored, "event_ts")


@query
def silver_vehicle_positions_stream(spark, sf_dir):
    config = _run_job(VEHICLE_POSITIONS, spark, sf_dir, enable_silver_sink=True)
    stored = read_table(spark, config.silver_table(VEHICLE_POSITIONS), schema=SILVER_VEHICLE_POSITIONS)
    return _epoch(stored, "event_ts")


# --- Live views, as a batch and as a stream


@query
def live_delay(spark, sf_dir):
    return live_view(fx.silver_updates(spark, sf_dir), DELAY_VIEW, NOW)


@query
def live_delay_stream(spark, sf_dir):
    config = _run_job(TRIP_UPDATES, spark, sf_dir, enable_live_sink=True)
    return LiveTable(spark, config.live_table(TRIP_UPDATES), DELAY_VIEW).read(NOW)


@query
def live_vehicle(spark, sf_dir):
    return live_view(_named_positions(spark, sf_dir), VEHICLE_VIEW, NOW)


@query
def live_vehicle_stream(spark, sf_dir):
    config = _run_job(VEHICLE_POSITIONS, spark, sf_dir, enable_live_sink=True)
    return LiveTable(spark, config.live_table(VEHICLE_POSITIONS), VEHICLE_VIEW).read(NOW)


@query
def live_vehicle_keyed(spark, sf_dir):
    """The live vehicle view from keyed streaming state; its lifetimes follow the real clock and are left out."""
    config = _run_job(VEHICLE_POSITIONS, spark, sf_dir, enable_live_sink=True, keyed_live_state=True, live_ttl_seconds=86400)
    changes = LiveChanges(spark, config.live_table(VEHICLE_POSITIONS), VEHICLE_VIEW)
    return changes.read(0).drop("expires_at")


# The clock at each of three landings of the topic, and when the view is read, in seconds after ``NOW``.
LANDED_AT, READ_AT = (0, 60, 130), 170


@query
def live_expiry_stream(spark, sf_dir):
    """The live vehicle view after three landings of its topic with an advancing clock.

    By trip number, a trip is in the first landing only, in the first and third, in the first and second, or in all.
    """
    base = fresh_dir(spark, "expiry")
    write_static(spark, sf_dir, f"{base}/static", "routes", "trips")
    config = JobConfig(
        static_path=f"{base}/static", live_path=f"{base}/live", checkpoint_path=f"{base}/c", enable_live_sink=True
    )
    landing = F.expr(
        "CASE trip % 4 WHEN 0 THEN 0 WHEN 1 THEN (event % 2) * 2 WHEN 2 THEN event % 2 ELSE event % 3 END"
    )
    parsed = F.from_json(F.col("value").cast("string"), VEHICLE_POSITION_MESSAGE)
    numbers = {"trip": parsed["vehicle"]["trip"]["trip_id"].cast("long"), "event": parsed["entity_id"].cast("long")}
    records = vehicle_records(spark, sf_dir).withColumns(numbers).withColumn("landing", landing)
    for number, seconds in enumerate(LANDED_AT):
        records.filter(F.col("landing") == number).select("value").write.mode("append").parquet(f"{base}/topic")
        replay = replay_topic(spark, f"{base}/topic")
        clock = functools.partial(int, NOW + seconds)
        for running in start_vehicle_positions(spark, config, replay, {"availableNow": True}, clock):
            running.awaitTermination()
    return LiveTable(spark, config.live_table(VEHICLE_POSITIONS), VEHICLE_VIEW).read(NOW + READ_AT)


# --- Deduplication and marts


@contextlib.contextmanager
def _made_once(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows that land in several parts, each a pass over them. They are on the executors' disks, which leaves the memory to the jobs."""
    kept = rows.persist(StorageLevel.DISK_ONLY)
    try:
        yield kept
    finally:
        kept.unpersist()


@contextlib.contextmanager
def _stored_once(rows: DataFrame) -> Iterator[DataFrame]:
    """Like ``_made_once``, by files below the shared folder. These take half the disk of kept rows, and the shuffles that the
    rows are made by go when they are written, where those of kept rows stay as long as these.
    """
    spark, path = rows.sparkSession, fresh_dir(rows.sparkSession, "landing")
    try:
        with set_for_now(spark, SHUFFLES_GO):
            rows.write.parquet(path, compression="zstd")
        yield spark.read.schema(rows.schema).parquet(path)
    finally:
        delete(spark, path)


@query
def dedup_latest(spark, sf_dir):
    return _epoch(marts.dedup_latest(fx.silver_updates(spark, sf_dir)), "event_ts")


@query
def high_water_mark(spark, sf_dir):
    return max_mark(fx.silver_updates(spark, sf_dir))


@query
def stored_mark(spark, sf_dir):
    """The mark of a stored table, from the footers of its newest hour."""
    path = f"{fresh_dir(spark, 'mark')}/silver"
    append_silver(fx.silver_updates(spark, sf_dir), path)
    return footer_scan(spark, next(hour_folders(spark, path)), "source_timestamp")


@query
def silver_closed_hours(spark, sf_dir):
    """Silver of which the earlier hours were rewritten into few files and have got late rows since."""
    path = f"{fresh_dir(spark, 'closed')}/silver"
    part = F.pmod(F.xxhash64("trip_id", "stop_sequence"), F.lit(5))
    with _made_once(fx.silver_updates(spark, sf_dir)) as updates:
        append_silver(updates.filter(part != 0), path)
        close_hours(spark, path, SPLIT, least_files=1)
        append_silver(updates.filter(part == 0), path)
    return read_silver(spark, path, schema=SILVER_TRIP_UPDATES).select(
        "trip_id", "stop_sequence", "source_timestamp", "effective_stop_time", "scheduled_stop_time", "delay_seconds"
    )


@query
def stop_hourly(spark, sf_dir):
    deduped = marts.dedup_latest(fx.silver_updates(spark, sf_dir), TIES)
    return marts.stop_hourly(deduped, fx.stops(spark, sf_dir))


@query
def route_hourly(spark, sf_dir):
    deduped = marts.dedup_latest(fx.silver_updates(spark, sf_dir), TIES)
    return marts.route_hourly(deduped, fx.trips(spark, sf_dir), fx.routes(spark, sf_dir))


def _two_runs(spark, sf_dir, spec: UpsertSpec, first_lacks: str | None = None) -> DataFrame:
    """Write silver up to the split, upsert, write the rest, upsert again; the table that results."""
    base = fresh_dir(spark, "incremental")
    landed, target = f"{base}/silver", f"{base}/deduped"
    with _made_once(fx.silver_updates(spark, sf_dir)) as updates:
        early = updates.filter(F.col("source_timestamp") <= SPLIT)
        append_silver(early.drop(first_lacks) if first_lacks else early, landed)
        upsert_latest(spark, read_table(spark, landed), target, spec)
        append_silver(updates.filter(F.col("source_timestamp") > SPLIT), landed)
    upsert_latest(spark, read_table(spark, landed), target, spec)
    return read_table(spark, target)


@query
def incremental_dedup(spark, sf_dir):
    return _epoch(_two_runs(spark, sf_dir, marts.DEDUP), "event_ts")


@query
def late_rows(spark, sf_dir):
    """Two runs, of which the second finds rows up to three days older than the mark of the first."""
    base = fresh_dir(spark, "late")
    landed, target = f"{base}/silver", f"{base}/deduped"
    clock, days = F.col("source_timestamp"), 3 * 86400
    late = (clock > SPLIT) | (clock > SPLIT - days) & (F.col("stop_sequence") == 2)
    spec = UpsertSpec(keys=marts.DEDUP_KEYS, late_seconds=days)
    with _stored_once(fx.silver_updates(spark, sf_dir)) as updates:
        append_silver(updates.filter(~late), landed)
        upsert_latest(spark, read_table(spark, landed), target, spec)
        append_silver(updates.filter(late), landed)
    upsert_latest(spark, read_table(spark, landed), target, spec)
    return _epoch(read_table(spark, target), "event_ts")


@query
def schema_append(spark, sf_dir):
    column = "effective_stop_time_calculation_method"
    spec = UpsertSpec(keys=marts.DEDUP_KEYS, ties=TIES)
    return _two_runs(spark, sf_dir, spec, column).select(*marts.DEDUP_KEYS, "source_timestamp", column)


def _store_dimensions(spark, sf_dir, base: str, versions: str = "TRUE") -> None:
    for name, dimension in {"stops": fx.stops, "trips": fx.trips, "routes": fx.routes}.items():
        tagged = dimension(spark, sf_dir).withColumns(
            {"transport_mode": F.lit("bus"), "valid_from": F.to_date("ingested_at")}
        )
        append_snapshot(tagged.filter(versions), f"{base}/static/{name}")


@query
def schema_growth_refresh(spark, sf_dir):
    """Silver gains a column between two refreshes of the marts; the deduplicated table has it from then on."""
    base = fresh_dir(spark, "growth")
    _store_dimensions(spark, sf_dir, base)
    with _stored_once(fx.silver_updates(spark, sf_dir)) as updates:
        append_silver(updates.filter(F.col("source_timestamp") <= SPLIT), f"{base}/silver")
        refresh(spark, base)
        grown = updates.filter(F.col("source_timestamp") > SPLIT)
        append_silver(grown.withColumn("note", F.col("stop_id")), f"{base}/silver")
    refresh(spark, base)
    stored = read_table(spark, f"{base}/gold/trip_updates_deduped")
    return stored.select(*marts.DEDUP_KEYS, "source_timestamp", (F.col("note") == F.col("stop_id")).alias("noted"))


def refresh_inputs(spark: SparkSession, sf_dir: str, base: str, second: bool, updates: DataFrame | None = None) -> None:
    """Silver rows up to the split or after it, and the first or second version of the dimensions.

    ``updates`` are the rows of both parts, for callers that write the two.
    """
    updates = _batch_trip_updates(spark, sf_dir) if updates is None else updates
    first_version = "ingested_at < TIMESTAMP '2024-01-01 00:01:00Z'"
    append_silver(updates.filter((F.col("source_timestamp") > SPLIT) == second), f"{base}/silver")
    _store_dimensions(spark, sf_dir, base, f"NOT ({first_version})" if second else first_version)


def refresh(spark: SparkSession, base: str, late_seconds: int = 0) -> None:
    marts.refresh_marts(spark, f"{base}/silver", f"{base}/static", f"{base}/gold", late_seconds=late_seconds)


def _refreshed(table: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marts after two refreshes, between which silver grew and the dimensions changed."""
    base = fresh_dir(spark, "marts")
    with _stored_once(_batch_trip_updates(spark, sf_dir)) as updates:
        refresh_inputs(spark, sf_dir, base, False, updates)
        refresh(spark, base)
        refresh_inputs(spark, sf_dir, base, True, updates)
    refresh(spark, base)
    return read_mart(spark, f"{base}/gold/{table}")


@query
def late_refresh(spark, sf_dir):
    """The stop mart after two refreshes, of which the second finds rows up to three days older than the first one's mark."""
    base, days = fresh_dir(spark, "late-marts"), 3 * 86400
    _store_dimensions(spark, sf_dir, base)
    clock = F.col("source_timestamp")
    late = (clock > SPLIT) | (clock > SPLIT - days) & (F.col("stop_sequence") == 2)
    with _stored_once(fx.silver_updates(spark, sf_dir)) as updates:
        append_silver(updates.filter(~late), f"{base}/silver")
        refresh(spark, base, days)
        append_silver(updates.filter(late), f"{base}/silver")
    refresh(spark, base, days)
    return read_mart(spark, f"{base}/gold/stop_hourly")


@query
def route_hourly_refresh(spark, sf_dir):
    return _refreshed("route_hourly", spark, sf_dir)


@query
def stop_hourly_refresh(spark, sf_dir):
    return _refreshed("stop_hourly", spark, sf_dir)
