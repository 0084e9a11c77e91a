"""Registry of realtime feeds and the scan of their landed snapshots."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from headway.operators.feeds import trip_update_messages, union_feeds, vehicle_messages
from headway.schemas import FEED_SNAPSHOT

VEHICLE_POSITIONS = "vehicle_positions"
TRIP_UPDATES = "trip_updates"

# Seconds between two publications of each mode's feeds.
POLL_SECONDS = {"tram": 60, "bus": 5, "metro": 5}


@dataclass(frozen=True)
class Feed:
    """One landed feed; its topic is also the kind of message it carries."""

    mode: str
    topic: str
    interval_seconds: int

    def path(self, base: str) -> str:
        return f"{base}/{self.mode}/{self.topic}"


FEEDS = tuple(
    Feed(mode, topic, seconds) for topic in (VEHICLE_POSITIONS, TRIP_UPDATES) for mode, seconds in POLL_SECONDS.items()
)

_MESSAGES = {VEHICLE_POSITIONS: vehicle_messages, TRIP_UPDATES: trip_update_messages}


def read_feeds(spark: SparkSession, base: str, topic: str) -> DataFrame:
    """Landed snapshots of every mode that feeds ``topic``, merged and tagged with their mode."""
    landed = spark.read.schema(FEED_SNAPSHOT)
    return union_feeds({feed.mode: landed.parquet(feed.path(base)) for feed in FEEDS if feed.topic == topic})


def stream_feeds(spark: SparkSession, base: str, topic: str) -> DataFrame:
    """The same as a stream of the snapshots as they land."""
    landing = spark.readStream.schema(FEED_SNAPSHOT)
    return union_feeds({feed.mode: landing.parquet(feed.path(base)) for feed in FEEDS if feed.topic == topic})


def feed_messages(snapshots: DataFrame, topic: str) -> DataFrame:
    """Self-contained messages for ``topic`` from merged snapshots."""
    return _MESSAGES[topic](snapshots)
