"""Enrichment of realtime rows with schedule data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.sources.static import read_static


def join_static(
    realtime: DataFrame, static: DataFrame, keys: Sequence[str], how: str = "left", suffix: str | None = None
) -> DataFrame:
    """Realtime columns, then the static ones, of rows that agree in the ``keys``.

    A static column that realtime has as well gets ``suffix``; without one it is an error. No broadcast is forced:
    Spark picks it from the static side's measured size, and otherwise shuffles with adaptive splitting of hot keys.
    Duplicate static keys multiply realtime rows, as in any join.
    """
    shared = sorted(set(realtime.columns) & set(static.columns) - set(keys))
    if shared and suffix is None:
        raise ValueError(f"both sides have {shared}; give a suffix for the static ones")
    named = static.withColumnsRenamed({name: f"{name}{suffix}" for name in shared})
    added = [name for name in named.columns if name not in keys]
    return realtime.join(named, list(keys), how).select(*realtime.columns, *added)


def join_schedule(
    spark: SparkSession,
    realtime: DataFrame,
    paths: Sequence[str],
    keys: Sequence[str],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Left join with the union of static Parquet directories, read down to ``columns`` when given."""
    return join_static(realtime, read_static(spark, paths, columns), keys)


def with_effective_time(df: DataFrame) -> DataFrame:
    """Arrival time, else departure time, and which of the two it is."""
    arrival, departure = F.col("stop_arrival_time"), F.col("stop_departure_time")
    method = F.when(arrival.isNotNull(), "arrival").when(departure.isNotNull(), "departure")
    return df.select(
        "*",
        F.coalesce(arrival, departure).alias("effective_stop_time"),
        method.alias("effective_stop_time_calculation_method"),
    )


# What a display name falls back to, in order, and the text that stands in last.
NAME_FALLBACKS = {
    "resolved_route_name": (("route_short_name", "route_long_name", "route_id"), "UNKNOWN_ROUTE"),
    "resolved_headsign": (("trip_headsign",), "UNKNOWN_DESTINATION"),
}


def with_resolved_names(df: DataFrame) -> DataFrame:
    """Display names with their fallbacks."""
    return df.withColumns({name: F.coalesce(*columns, F.lit(last)) for name, (columns, last) in NAME_FALLBACKS.items()})
