"""Live latest-per-trip views with expiry."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LiveView:
    """A keyed view: SQL expressions for its fields, and the columns that say which row is newer."""

    prefix: str
    fields: Mapping[str, str] = field(hash=False)
    order: tuple[str, ...]
    ttl_seconds: int = 120
    key: str = "trip_id"

    def __post_init__(self):
        if not self.fields:
            raise ValueError("a live view needs at least one field")


# Field names and lifetime of the two views.
DELAY_VIEW = LiveView(
    prefix="delay",
    fields={"trip_id": "trip_id", "last_stop_sequence": "stop_sequence", "delay_seconds": "delay_seconds"},
    order=("source_timestamp", "stop_sequence"),
)
VEHICLE_VIEW = LiveView(
    prefix="vehicle",
    fields={
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
    order=("position_timestamp", "source_timestamp"),
)


def live_entries(df: DataFrame, view: LiveView) -> DataFrame:
    """``key``, the view's ``fields`` and the ``version`` of every row that has a key. Streams as well as batches."""
    return df.filter(F.col(view.key).isNotNull()).select(
        F.concat(F.lit(f"{view.prefix}:trip:"), F.col(view.key).cast("string")).alias("key"),
        F.struct(*view.order).alias("version"),
        F.struct(*(F.expr(text).alias(name) for name, text in view.fields.items())).alias("fields"),
    )


def merge_live(entries: DataFrame, stored: DataFrame | None, now: int, ttl_seconds: int) -> DataFrame:
    """Newest entry per key among ``entries`` and the unexpired ``stored`` ones.

    Every entry renews its key's lifetime, but an older one never replaces newer fields. Both parts are
    aggregates, so rows of a hot key are combined before the shuffle.
    """
    merged = entries.withColumn("expires_at", F.lit(now + ttl_seconds).cast("long"))
    if stored is not None:
        merged = merged.unionByName(stored.filter(F.col("expires_at") > now))
    return newest_entries(merged)


def newest_entries(entries: DataFrame) -> DataFrame:
    """Newest fields and latest expiry per key."""
    newest = entries.groupBy("key").agg(
        F.max(F.struct("version", "fields")).alias("newest"), F.max("expires_at").alias("expires_at")
    )
    return newest.select("key", "newest.version", "newest.fields", "expires_at")


def visible(stored: DataFrame, now: int) -> DataFrame:
    """Unexpired entries as ``key``, one column per field and ``expires_at``."""
    return stored.filter(F.col("expires_at") > now).select("key", "fields.*", "expires_at")


def live_view(df: DataFrame, view: LiveView, now: int) -> DataFrame:
    """The view as it stands right after all rows of ``df`` were written at ``now``."""
    return visible(merge_live(live_entries(df, view), None, now, view.ttl_seconds), now)
