"""Keyed live table."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.operators.live import LiveView, merge_live, newest_entries, visible
from headway.sinks.versions import RETAIN_SECONDS, Versions
from headway.storage import child_names, child_times, delete, exists


class LiveTable:
    """Each upsert writes one new version.

    Entries that have expired are left out of the next version, so its size follows the number of trips seen
    within one lifetime and not the length of the stream.
    """

    def __init__(self, spark: SparkSession, path: str, view: LiveView, retain_seconds: float = RETAIN_SECONDS):
        self.versions = Versions(spark, path, retain_seconds)
        self.view = view

    def upsert(self, entries: DataFrame, now: int) -> None:
        """Fold a batch of ``live_entries`` into the table. Repeating a batch after a failure changes nothing."""
        self.versions.add(merge_live(entries, self.versions.newest(), now, self.view.ttl_seconds))

    def read(self, now: int | None = None) -> DataFrame:
        """Entries that are still alive at ``now``."""
        stored = self.versions.newest()
        if stored is None:
            raise ValueError(f"nothing was written to {self.versions.path} yet")
        return visible(stored, seconds_now(now))


class LiveChanges:
    """The live table as the changes of its stream's latest batches, one folder each.

    A batch costs its own keys, not all live ones; a reader merges the batches of one lifetime. ``keyed_entries`` makes such
    batches. Folders go when they have been out of use for ``retain_seconds``.
    """

    def __init__(self, spark: SparkSession, path: str, view: LiveView, retain_seconds: float = RETAIN_SECONDS):
        self.spark, self.path, self.view, self.retain_seconds = spark, path, view, retain_seconds

    def add(self, changes: DataFrame, batch_id: int) -> None:
        """Write the changes of one batch; repeating it replaces them."""
        changes.write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")
        times = {name: t for name, t in child_times(self.spark, self.path).items() if name.startswith("batch=")}
        for name, written in times.items():
            if times[f"batch={batch_id}"] - written > self.view.ttl_seconds + self.retain_seconds:
                delete(self.spark, f"{self.path}/{name}")

    def read(self, now: int | None = None) -> DataFrame:
        """Entries that are still alive at ``now``."""
        names = [name for name in child_names(self.spark, self.path) if name.startswith("batch=")]
        folders = [f"{self.path}/{name}" for name in names if exists(self.spark, f"{self.path}/{name}/_SUCCESS")]
        if not folders:
            raise ValueError(f"nothing was written to {self.path} yet")
        stored = self.spark.read.parquet(*folders)
        return visible(newest_entries(stored.filter(F.col("expires_at") > seconds_now(now))), seconds_now(now))


def seconds_now(now: int | None = None) -> int:
    return int(time.time()) if now is None else now
