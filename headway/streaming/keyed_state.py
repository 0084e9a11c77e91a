"""The live view as keyed streaming state with a time to live.

Each trip's newest entry is a value in the stream's state store, which drops it when its lifetime has passed without a new
one. A micro-batch touches the keys it has rows of and no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructField, StructType

from headway.operators.live import LiveView, live_entries

# Set before the stream starts: the only store that lets state expire, and no batches for the passing of time alone, which
# would keep a stream from ever having caught up. Expired entries count as absent and are removed with the next rows.
STATE_SETTINGS = {
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def _processor(names: list[str], order: list[str], entry: StructType, ttl_seconds: int) -> StatefulProcessor:
    """Keeps the newest entry of a key. Defined here to be shipped to the workers by value."""

    def age(values: tuple) -> tuple:
        """Orders versions and then fields, NULL before everything."""
        return tuple((value is not None, value) for value in values)

    class NewestEntry(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.newest = handle.getValueState("newest", entry, ttl_seconds * 1000)

        def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
            stored = self.newest.get()
            best = None if stored is None else tuple(stored)
            for row in rows:
                found = tuple(row[name] for name in names)
                if best is None or age(found) > age(best):
                    best = found
            self.newest.update(best)  # an older row renews the lifetime too
            expires = timerValues.getCurrentProcessingTimeInMs() // 1000 + ttl_seconds
            yield Row("key", *names, "expires_at")(*key, *best, expires)

        def close(self) -> None:
            pass

    return NewestEntry()


def keyed_entries(df: DataFrame, view: LiveView) -> DataFrame:
    """The entries of the keys that each micro-batch of a stream has rows of, as ``merge_live`` gives them for a batch.

    Rows of a hot key are reduced to the newest one of each Arrow batch before they are shuffled.
    """
    entries = live_entries(df, view)
    version, fields = (entries.schema[name].dataType for name in ("version", "fields"))
    parts = [*(("version", f) for f in version), *(("fields", f) for f in fields)]
    names = [f"{group}_{f.name}" for group, f in parts]
    flat = entries.select("key", *(F.col(f"{group}.{f.name}").alias(name) for (group, f), name in zip(parts, names)))
    entry = StructType([StructField(name, f.dataType) for name, (_, f) in zip(names, parts)])

    def newest_of_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.sort_values(names, na_position="first", kind="stable").drop_duplicates("key", keep="last")

    flat = flat.mapInPandas(newest_of_batch, flat.schema)
    result = StructType([flat.schema["key"], *entry.fields]).add("expires_at", "long")
    order = names[: len(version)]
    newest = flat.groupBy("key").transformWithState(
        _processor(names, order, entry, view.ttl_seconds), result, outputMode="Update", timeMode="ProcessingTime"
    )
    structs = {"version": names[: len(version)], "fields": names[len(version) :]}
    built = [
        F.struct(*(F.col(name).alias(name.removeprefix(f"{group}_")) for name in members)).alias(group)
        for group, members in structs.items()
    ]
    return newest.select("key", *built, "expires_at")
