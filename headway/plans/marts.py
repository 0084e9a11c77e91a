"""Deduplicated trip updates and the two hourly punctuality marts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from headway.functions import EVENT_PARTITIONS, epoch_of, from_hour
from headway.operators.enrich import join_static
from headway.operators.incremental import (
    Upsert,
    UpsertSpec,
    dated,
    hours_among,
    hours_from,
    in_hours,
    is_loaded,
    joint_path,
    newest_hour,
    plan_upsert,
    publish_together,
    replace_hours,
    settle_together,
    stage_jointly,
    stored_hour,
    stored_mark,
    upsert_latest,
)
from headway.operators.latest import latest_by
from headway.schemas import SILVER_TRIP_UPDATES
from headway.sinks.closed import read_silver
from headway.sinks.tables import read_table, replace_mart
from headway.sources.static import read_snapshots

# Identity of a deduplicated stop update, and the on-time limit.
DEDUP_KEYS = ("trip_id", "route_id", *EVENT_PARTITIONS, "stop_sequence")
ON_TIME_BELOW_SECONDS = 30
HOUR = ("mode", *EVENT_PARTITIONS)

DEDUP = UpsertSpec(keys=DEDUP_KEYS)


def dedup_latest(updates: DataFrame, ties: Sequence[str] | None = None) -> DataFrame:
    """The newest prediction for each stop of a trip within each event hour; rows without an hour are left out."""
    return latest_by(dated(updates), DEDUP_KEYS, ["source_timestamp"], ties)


def latest_version(dimension: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Newest ingested row per key of a dimension, narrowed to ``keys`` and ``columns``."""
    wanted = list(dict.fromkeys([*keys, *columns]))
    return latest_by(dimension.select(*wanted, "ingested_at"), keys, ["ingested_at"]).select(*wanted)


def hourly_counts(deduped: DataFrame, key: str) -> DataFrame:
    """Stops made and stops on time per ``key``, mode and hour.

    A stop is on time when it is less than the limit late, early included; an unknown delay is not.
    """
    on_time = F.count_if(F.col("delay_seconds") < ON_TIME_BELOW_SECONDS)
    return deduped.groupBy(key, *HOUR).agg(F.count("*").alias("total_stops"), on_time.alias("on_time_stops"))


def stop_hourly(deduped: DataFrame, stops: DataFrame, by_mode: bool = False) -> DataFrame:
    """Stops made and stops on time per stop, mode and hour, with the stop's name.

    Ids of different modes share one namespace unless ``by_mode`` is set, which also matches ``transport_mode``.
    """
    return stop_mart(hourly_counts(deduped, "stop_id"), stops, by_mode)


def stop_mart(per_stop: DataFrame, stops: DataFrame, by_mode: bool = False) -> DataFrame:
    """The stop mart from its hourly counts."""
    return _look_up(per_stop, stops, "stop_id", ["stop_name"], by_mode)


def route_hourly(deduped: DataFrame, trips: DataFrame, routes: DataFrame, by_mode: bool = False) -> DataFrame:
    """Stops made and stops on time per route, mode and hour, with the route's names.

    The route comes from the trip dimension. That holds one row per trip, so stops are first counted per trip
    and hour, and only those counts are shuffled to the trips: a trip that dominates the data arrives there as
    one row per hour.
    """
    return route_mart(hourly_counts(deduped, "trip_id"), trips, routes, by_mode)


def route_mart(per_trip: DataFrame, trips: DataFrame, routes: DataFrame, by_mode: bool = False) -> DataFrame:
    """The route mart from hourly counts per trip."""
    per_route = _look_up(per_trip, trips, "trip_id", ["route_id"], by_mode)
    stats = per_route.groupBy("route_id", *HOUR).agg(
        F.sum("total_stops").alias("total_stops"), F.sum("on_time_stops").alias("on_time_stops")
    )
    return _look_up(stats, routes, "route_id", ["route_short_name", "route_long_name"], by_mode)


def _look_up(facts: DataFrame, dimension: DataFrame, key: str, columns: list[str], by_mode: bool) -> DataFrame:
    """Left join with the newest version of a dimension; adds ``columns``."""
    if not by_mode:
        return join_static(facts, latest_version(dimension, [key], columns), [key])
    current = latest_version(dimension, [key, "transport_mode"], columns).withColumnRenamed("transport_mode", "mode")
    return join_static(facts, current, [key, "mode"])


def _grown_schema(spark: SparkSession, silver_path: str, deduped_path: str, table_format: str, late_seconds: int) -> StructType:
    """The declared silver columns, and those the silver files of the hours that are still to be read have besides.

    The first run, which reads everything, looks at the newest hour: columns are only ever added.
    """
    if table_format != "parquet":
        return SILVER_TRIP_UPDATES  # such a table keeps its own schema, which a read takes as it is
    mark = stored_mark(spark, deduped_path, DEDUP.mark)
    unread = newest_hour(spark, silver_path) if mark is None else hours_from(spark, silver_path, mark - late_seconds)
    found = [] if unread is None else unread.schema.fields
    return StructType([*SILVER_TRIP_UPDATES.fields, *(f for f in found if f.name not in SILVER_TRIP_UPDATES.names)])


# The two tables of hourly counts and what each counts by.
COUNTS = {"stop_counts": "stop_id", "trip_counts": "trip_id"}


def weighed_counts(rows: DataFrame, weight: str) -> DataFrame:
    """Hourly counts by stop and by trip in one pass over ``rows``, each row counted ``weight`` times.

    ``by_trip`` says which of the two a row of the result is; the other key is NULL in it.
    """
    keys = [F.col(name) for name in (*COUNTS.values(), *HOUR)]
    hour = [F.col(name) for name in HOUR]
    on_time = F.when(F.col("delay_seconds") < ON_TIME_BELOW_SECONDS, F.col(weight)).otherwise(0)
    grouped = rows.groupingSets([[F.col(key), *hour] for key in COUNTS.values()], *keys)
    return grouped.agg(
        (F.grouping("trip_id") == 0).alias("by_trip"),
        F.sum(weight).cast("bigint").alias("total_stops"),
        F.sum(on_time).cast("bigint").alias("on_time_stops"),
    )


def _of_table(counts: DataFrame, name: str) -> DataFrame:
    key = COUNTS[name]
    return counts.filter(F.col("by_trip") == (key == "trip_id")).select(key, *HOUR, "total_stops", "on_time_stops")


def recount(deduped: DataFrame, target_path: str, table_format: str = "parquet", late_seconds: int = 0) -> None:
    """Bring both tables of counts up to date from the deduplicated table alone.

    An upsert changes no hour before the newest one it found, less the seconds it looks back, and the counts reach up to that
    hour. Only from there on are hours counted again, which makes up for a refresh that was lost after its upsert. Where a
    table of counts is missing, everything is counted.
    """
    spark, paths = deduped.sparkSession, {name: f"{target_path}/{name}" for name in COUNTS}
    newest = [stored_hour(spark, path, table_format) if is_loaded(spark, path) else None for path in paths.values()]
    hours = [None if rows is None else rows.select(*EVENT_PARTITIONS).first() for rows in newest]
    first = None in hours
    changed = deduped if first else deduped.filter(from_hour(min(map(epoch_of, hours)) - late_seconds))
    counts = weighed_counts(changed.withColumn("weight", F.lit(1)), "weight").persist()
    for name, path in paths.items():
        replace_hours(_of_table(counts, name), path, table_format, first=first)
    counts.unpersist()


def changed_counts(planned: Upsert, staged: str) -> DataFrame:
    """Counts of the rows that an upsert has gained, less those of the rows lost, by stop and by trip.

    Hours that were not stored before consist of gained rows, which are read from where the deduplicated table is ``staged``,
    so that no new row is ranked or kept for its count. Of the stored hours only the rows that are gained or lost are read.
    """
    needed = [*COUNTS.values(), *HOUR, "delay_seconds"]
    rows = planned.rows.sparkSession.read.schema(planned.rows.schema).parquet(staged)
    if planned.stored:
        rows = rows.filter(~in_hours(planned.stored))
    changes = rows.select(*needed, F.lit(1).alias("weight"))
    for changed, weight in ((planned.regained, 1), (planned.lost, -1)):
        if changed is not None:
            changes = changes.unionByName(changed.select(*needed, F.lit(weight).alias("weight")))
    return weighed_counts(changes, "weight")


def renewed_counts(difference: DataFrame, name: str, path: str, hours: Sequence[tuple[int, ...]]) -> DataFrame:
    """One table's counts of the touched hours: the stored ones and their change. A count that has come to zero is left out."""
    rows, found = _of_table(difference, name), hours_among(difference.sparkSession, path, hours)
    both = rows if found is None else rows.unionByName(found[0].select(rows.columns))
    sums = [F.sum(column).alias(column) for column in ("total_stops", "on_time_stops")]
    return both.groupBy(COUNTS[name], *HOUR).agg(*sums).filter("total_stops != 0")


def refresh_tables(
    spark: SparkSession, silver: DataFrame, target_path: str, table_format: str = "parquet", late_seconds: int = 0
) -> None:
    """Fold new silver rows into the deduplicated table and the hourly counts.

    The deduplicated table and the counts change together or not at all, so that counts kept by difference cannot drift.
    Where the counts are missing, and in a table format whose tables cannot be replaced together, they are counted from
    the deduplicated table.
    """
    deduped_path, marker = f"{target_path}/trip_updates_deduped", f"{target_path}/refresh_staged"
    paths = [deduped_path, *(f"{target_path}/{name}" for name in COUNTS)]
    spec = replace(DEDUP, late_seconds=late_seconds)
    together = table_format == "parquet" and all(is_loaded(spark, path) for path in paths)
    if together:
        settle_together(spark, paths, marker)
        planned = plan_upsert(spark, silver, deduped_path, spec, keep=True)
        together = planned.mark is not None  # a table without rows is loaded anew
        if together and planned.hours:
            stage_jointly(planned.rows, deduped_path)
            difference = changed_counts(planned, joint_path(deduped_path)).persist()
            for name in COUNTS:
                path = f"{target_path}/{name}"
                stage_jointly(renewed_counts(difference, name, path, planned.hours), path)
            difference.unpersist()
            publish_together(spark, paths, marker)
        planned.done()
    if not together:
        upsert_latest(spark, silver, deduped_path, spec, table_format)
        recount(read_table(spark, deduped_path, table_format, SILVER_TRIP_UPDATES), target_path, table_format, late_seconds)


def refresh_marts(
    spark: SparkSession,
    silver_path: str,
    static_path: str,
    target_path: str,
    table_format: str = "parquet",
    late_seconds: int = 0,
) -> None:
    """Fold new silver rows into the deduplicated table and bring both marts up to date.

    Rows up to ``late_seconds`` older than the newest stored one are still taken in. Columns that silver has gained go with
    them: they are looked for in the files of the hours to be read. The dimensions join counts of past hours anew, as a
    changed one alters them; the rows behind those counts are not read again.
    """
    deduped_path = f"{target_path}/trip_updates_deduped"
    schema = _grown_schema(spark, silver_path, deduped_path, table_format, late_seconds)
    silver = read_silver(spark, silver_path, table_format, schema)
    refresh_tables(spark, silver, target_path, table_format, late_seconds)

    def counts(name: str) -> DataFrame:
        schema = SILVER_TRIP_UPDATES[COUNTS[name]].dataType
        declared = StructType([StructField(COUNTS[name], schema), *(SILVER_TRIP_UPDATES[column] for column in HOUR)])
        return read_table(spark, f"{target_path}/{name}", table_format, declared.add("total_stops", "long").add("on_time_stops", "long"))

    def dimension(name: str) -> DataFrame:
        return read_snapshots(spark, f"{static_path}/{name}", table_format)

    replace_mart(stop_mart(counts("stop_counts"), dimension("stops")), f"{target_path}/stop_hourly", table_format)
    routes = route_mart(counts("trip_counts"), dimension("trips"), dimension("routes"))
    replace_mart(routes, f"{target_path}/route_hourly", table_format)
