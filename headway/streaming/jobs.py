"""The streaming jobs: landed feeds to topics, and each topic to its enabled sinks."""

from __future__ import annotations

import functools
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from headway.config import JobConfig
from headway.operators.key_filter import key_bits, only_matching
from headway.operators.latest import latest_by
from headway.operators.live import DELAY_VIEW, VEHICLE_VIEW, LiveView, live_entries
from headway.plans.silver import (
    ROUTE_COLUMNS,
    STOP_TIME_COLUMNS,
    STOP_TIME_KEYS,
    TRIP_COLUMNS,
    TRIP_KEYS,
    delayed_stops,
    flat_trip_updates,
    named_positions,
    service_schedule,
    silver_vehicle_positions,
)
from headway.schemas import TRIP_UPDATE_MESSAGE, VEHICLE_POSITION_MESSAGE, load_schema
from headway.sinks.live import LiveChanges, LiveTable, seconds_now
from headway.sinks.tables import append_batch
from headway.sinks.topics import start_publishing, start_recording
from headway.sinks.versions import Versions
from headway.sources.feeds import TRIP_UPDATES, VEHICLE_POSITIONS, feed_messages, stream_feeds
from headway.sources.static import read_newest_snapshots, read_static
from headway.sources.topics import stream_topic
from headway.streaming.keyed_state import STATE_SETTINGS, keyed_entries


@dataclass(frozen=True)
class Steps:
    """What a job makes of a topic: flat rows of the stream, silver rows of a batch of these, live rows of the silver ones.

    ``live`` takes a batch and may give the newest row of each trip alone; ``live_stream`` takes a stream, row by row.
    """

    flat: Callable[[DataFrame], DataFrame]
    silver: Callable[[DataFrame], DataFrame]
    live: Callable[[DataFrame], DataFrame]
    live_stream: Callable[[DataFrame], DataFrame]


def start_trip_updates(
    spark: SparkSession,
    config: JobConfig,
    records: DataFrame | None = None,
    trigger: dict | None = None,
    clock: Callable[[], int] | None = None,
) -> list[StreamingQuery]:
    """Trip updates: enriched silver rows and the live delay view.

    ``records`` replaces the Kafka topic (a replay, say); ``trigger`` replaces the configured one.
    """
    if not (config.enable_live_sink or config.enable_silver_sink):
        return []
    schedule = _stored_schedule(spark, config)

    def silver(stops: DataFrame) -> DataFrame:
        """Only the schedule of the trips in the batch is shuffled to it."""
        needed = only_matching(schedule, key_bits(stops, STOP_TIME_KEYS), STOP_TIME_KEYS)
        return delayed_stops(stops, needed, config.timezone)

    flat = functools.partial(flat_trip_updates, schema=_message_schema(config, TRIP_UPDATES, TRIP_UPDATE_MESSAGE))
    steps = Steps(flat, silver, lambda updates: updates, lambda updates: updates)
    records = records or stream_topic(spark, TRIP_UPDATES, config.kafka_bootstrap_servers)
    return _start_sinks(config, TRIP_UPDATES, records, steps, DELAY_VIEW, trigger, clock)


def start_vehicle_positions(
    spark: SparkSession,
    config: JobConfig,
    records: DataFrame | None = None,
    trigger: dict | None = None,
    clock: Callable[[], int] | None = None,
) -> list[StreamingQuery]:
    """Vehicle positions: silver rows as received, and the live view with route and trip names."""
    if not (config.enable_live_sink or config.enable_silver_sink):
        return []
    routes, trips = _static(spark, config, "routes", ROUTE_COLUMNS), _static(spark, config, "trips", TRIP_COLUMNS)
    schema = _message_schema(config, VEHICLE_POSITIONS, VEHICLE_POSITION_MESSAGE)
    flat = functools.partial(silver_vehicle_positions, schema=schema)

    def live(rows: DataFrame) -> DataFrame:
        """Names for the newest row of each trip, from the trips of the batch; no other trip is shuffled to it.

        A name follows from the ids of its row, so what is newest does not depend on it, with repeated ids neither.
        """
        given = [text for text in VEHICLE_VIEW.fields.values() if text in rows.columns]
        ties = [name for name in given if name not in (VEHICLE_VIEW.key, *VEHICLE_VIEW.order)]
        newest = latest_by(rows.filter(F.col(VEHICLE_VIEW.key).isNotNull()), [VEHICLE_VIEW.key], VEHICLE_VIEW.order, ties)
        needed = only_matching(trips, key_bits(rows, TRIP_KEYS), TRIP_KEYS)
        return named_positions(newest, routes, needed)

    steps = Steps(flat, lambda rows: rows, live, lambda rows: named_positions(rows, routes, trips))
    records = records or stream_topic(spark, VEHICLE_POSITIONS, config.kafka_bootstrap_servers)
    return _start_sinks(config, VEHICLE_POSITIONS, records, steps, VEHICLE_VIEW, trigger, clock)


def start_feed(
    spark: SparkSession,
    topic: str,
    landed: str,
    checkpoint: str,
    bootstrap_servers: str | None = None,
    recording: str | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Snapshots of every mode as they land, as messages to ``topic``; ``recording`` is a folder in its place."""
    messages = feed_messages(stream_feeds(spark, landed, topic), topic)
    if recording:
        return start_recording(messages, recording, checkpoint, trigger)
    return start_publishing(messages, topic, bootstrap_servers, checkpoint, trigger)


def _message_schema(config: JobConfig, topic: str, declared: StructType) -> StructType:
    return load_schema(f"{config.schema_path}/{topic}.json") if config.schema_path else declared


def _static(spark: SparkSession, config: JobConfig, table: str, columns: tuple[str, ...]) -> DataFrame:
    if config.snapshot_path:
        return read_newest_snapshots(spark, f"{config.snapshot_path}/{table}", columns)
    return read_static(spark, config.static_paths(table), columns)


def _stored_schedule(spark: SparkSession, config: JobConfig) -> DataFrame:
    """Times of day parsed once when the job starts, so that a micro-batch reads numbers.

    Each start adds a version beside the checkpoints. Nothing but another start replaces the one a job reads.
    """
    stored = Versions(spark, config.checkpoint(TRIP_UPDATES, "schedule"))
    stored.add(service_schedule(_static(spark, config, "stop_times", STOP_TIME_COLUMNS)))
    return stored.newest()


def _start_sinks(
    config: JobConfig,
    topic: str,
    records: DataFrame,
    steps: Steps,
    view: LiveView,
    trigger: dict | None,
    clock: Callable[[], int] | None,
) -> list[StreamingQuery]:
    """One query for all enabled sinks: each micro-batch is read, parsed and joined once.

    Keyed live state needs a query of its own, as the state belongs to the stream and not to a batch.
    """
    view = replace(view, ttl_seconds=config.live_ttl_seconds)
    spark, flat = records.sparkSession, steps.flat(records)
    every = trigger or {"processingTime": config.silver_trigger}
    keyed = config.enable_live_sink and config.keyed_live_state
    both = config.enable_live_sink and config.enable_silver_sink and not keyed

    def write(batch: DataFrame, batch_id: int) -> None:
        writer_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        kept = [batch.persist()]
        try:
            # Fills the cache. Several uses that start at once would wait for each other's tasks, or parse again elsewhere.
            kept[0].count()
            rows = steps.silver(kept[0])
            if both and rows is not kept[0]:
                kept.append(rows.persist())
            if config.enable_silver_sink:
                append_batch(rows, config.silver_table(topic), batch_id, writer_id, config.table_format)
            if config.enable_live_sink and not keyed:
                entries = live_entries(steps.live(rows), view)
                LiveTable(batch.sparkSession, config.live_table(topic), view).upsert(entries, seconds_now(clock and clock()))
        finally:
            for frame in kept:
                frame.unpersist()

    def write_changes(batch: DataFrame, batch_id: int) -> None:
        LiveChanges(batch.sparkSession, config.live_table(topic), view).add(batch, batch_id)

    def start(df: DataFrame, job: Callable[[DataFrame, int], None], name: str) -> StreamingQuery:
        writer = df.writeStream.queryName(f"{topic}_{name}").foreachBatch(job).outputMode("update")
        return writer.option("checkpointLocation", config.checkpoint(topic, name)).trigger(**every).start()

    queries = []
    if keyed:
        for key, value in STATE_SETTINGS.items():
            spark.conf.set(key, value)
        queries.append(start(keyed_entries(steps.live_stream(steps.silver(flat)), view), write_changes, "live"))
    if config.enable_silver_sink or not keyed:
        queries.append(start(flat, write, "sinks"))
    return queries
