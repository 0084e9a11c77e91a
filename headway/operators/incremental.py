"""Incremental upsert of the newest row per key into an hour-partitioned table."""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from operator import and_

from py4j.protocol import Py4JError
from pyspark import StorageLevel
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions import EVENT_PARTITIONS, from_hour, hour_of
from headway.operators.key_filter import key_bits, may_match
from headway.operators.latest import age_columns, latest_by, named
from headway.session import SHUFFLES_GO, set_for_now
from headway.storage import child_names, delete, exists, make_dir, move


@dataclass(frozen=True)
class UpsertSpec:
    """Which columns identify a row, which epoch-second column orders versions, and what breaks ties.

    The table's hour partitions must derive from ``mark``. Rows up to ``late_seconds`` older than the stored mark are
    still taken in; the stored hours they may fall into are read back with them.
    """

    keys: tuple[str, ...]
    mark: str = "source_timestamp"
    ties: tuple[str, ...] | None = None
    late_seconds: int = 0


def max_mark(table: DataFrame, column: str = "source_timestamp") -> DataFrame:
    """One row with the greatest value of ``column``; NULL for an empty table."""
    return table.agg(F.max(column).alias(column))


def rows_after(source: DataFrame, mark: int | None, column: str = "source_timestamp") -> DataFrame:
    """Source rows strictly after ``mark``; all of them when there is none yet."""
    if mark is None:
        return source
    return source.filter(from_hour(mark) & (F.col(column) > mark))


def dated(source: DataFrame) -> DataFrame:
    """Rows that have an event hour. Others, whose clock is missing or out of range, belong to no partition."""
    return source.filter(F.col(EVENT_PARTITIONS[-1]).isNotNull())


def append_columns(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Union by name; columns that only one side has are NULL for the other."""
    return stored.unionByName(fresh, allowMissingColumns=True)


def newest_hour(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame | None:
    """The rows of the newest hour partition, or None for a table without one.

    For Parquet the hour is found by listing one directory per partition level, not by scanning the table. Folders
    that hold no files are passed over.
    """
    if table_format != "parquet":
        if not exists(spark, path):
            return None
        table = spark.read.format(table_format).load(path)
        newest = table.agg(F.max(F.struct(*EVENT_PARTITIONS)).alias("p")).select("p.*").first()
        return table.filter(F.struct(*EVENT_PARTITIONS) == F.struct(*(F.lit(v) for v in newest)))
    folder = next(hour_folders(spark, path), None)
    return None if folder is None else _read_hours(spark, path, [folder])


def hour_folders(spark: SparkSession, path: str, first: tuple[int, ...] = (), levels=EVENT_PARTITIONS) -> Iterator[str]:
    """Hour folders that hold files, newest first; ``first`` is the oldest hour (year to hour) to look at."""
    if not levels:
        if _holds_files(spark, path):
            yield path
        return
    prefix = f"{levels[0]}="
    values = [name.removeprefix(prefix) for name in child_names(spark, path) if name.startswith(prefix)]
    for number in sorted((int(value) for value in values if value.isdigit()), reverse=True):
        if first and number < first[0]:
            return
        # Only below the oldest year (month, day) is there more to compare.
        below = first[1:] if first and number == first[0] else ()
        yield from hour_folders(spark, f"{path}/{prefix}{number}", below, levels[1:])


def _read_hours(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    return spark.read.option("basePath", path).option("mergeSchema", True).parquet(*folders)


def hours_from(spark: SparkSession, path: str, epoch: int) -> DataFrame | None:
    """The rows of a Parquet table in the hour of ``epoch`` and later; opens the files of those hours only."""
    folders = list(hour_folders(spark, path, hour_of(epoch)))
    return _read_hours(spark, path, folders) if folders else None


@dataclass(frozen=True)
class Upsert:
    """What an upsert changes: new contents of the touched hours, and the rows these gain and lose.

    ``mark`` is the bound that was used, None for a first load. Of the ``hours``, ``stored`` ones had rows before; all rows of
    the others are gained, and ``regained`` are the gained rows of the stored ones. ``done`` lets go of what was kept.
    """

    mark: int | None
    hours: list[tuple[int, ...]]
    rows: DataFrame
    gained: DataFrame
    lost: DataFrame | None
    stored: Sequence[tuple[int, ...]] = ()
    regained: DataFrame | None = None
    done: Callable[[], object] = lambda: None


def plan_upsert(
    spark: SparkSession, source: DataFrame, target: str, spec: UpsertSpec, table_format: str = "parquet", keep: bool = False
) -> Upsert:
    """Compare the source rows after the stored mark with the stored rows of the hours they fall into.

    Only new rows are ranked. Where an hour is stored already, a fixed-size bit filter over the new rows' keys lets the
    stored rows that nothing replaces pass without a join or a rank; the few others meet the new rows of these hours by key, one
    row against one. The new rows of other hours, most of them as a rule, meet nothing.
    With ``keep`` the pairs that met are kept until ``done``, for callers that use them more than once: one join then serves what
    stays, what is lost and what is gained.
    """
    settle(spark, target)
    mark = stored_mark(spark, target, spec.mark, table_format)
    if mark is not None:
        mark -= spec.late_seconds
    unranked = rows_after(dated(source), mark, spec.mark)
    newest = functools.partial(latest_by, keys=spec.keys, order=[spec.mark], ties=spec.ties)
    if mark is None:
        return Upsert(None, [], newest(unranked), newest(unranked), None)
    hours = sorted(tuple(row) for row in unranked.select(*EVENT_PARTITIONS).distinct().collect())
    found = hours_among(spark, target, hours, table_format)
    if found is None:
        return Upsert(mark, hours, newest(unranked), newest(unranked), None)

    old, stored = found
    whole = append_columns(old.limit(0), unranked.limit(0)).schema
    within, beyond = (unranked.filter(held) for held in (in_hours(stored), ~in_hours(stored)))
    marked = may_match(_in_schema(old, whole), key_bits(within, spec.keys), spec.keys, "_may")
    apart, near = marked.filter("NOT _may").drop("_may"), marked.filter("_may").drop("_may")
    added = _in_schema(newest(beyond), whole)
    # The order among the new rows also decides between them and the stored ones; columns that only these have come last.
    ages = list(dict.fromkeys(c for s in (unranked.schema, whole) for c in age_columns(s, spec.keys, [spec.mark], spec.ties)))
    met = _pairs(near, _in_schema(newest(within), whole), spec.keys, ages)
    done = lambda: None
    if keep:
        met = met.persist(StorageLevel.DISK_ONLY)
        done = functools.partial(met.unpersist)
    lost, regained = met.filter("_old AND _beaten").select(*map(named, whole.names)), met.filter("_beaten").select("_new.*")
    if keep:
        settled = met.filter("NOT _beaten").select(*map(named, whole.names)).unionByName(regained)
    else:  # used once: one rank of both does it
        both = near.withColumn("_fresh", F.lit(False)).unionByName(_in_schema(within, whole).withColumn("_fresh", F.lit(True)))
        settled = latest_by(both, spec.keys, [*ages, "_fresh"], ()).drop("_fresh")
    rows, gained = apart.unionByName(settled).unionByName(added), regained.unionByName(added)
    return Upsert(mark, hours, rows, gained, lost, stored, regained, done)


def _pairs(old: DataFrame, new: DataFrame, keys: Sequence[str], ages: Sequence[str]) -> DataFrame:
    """Stored rows with ``_old`` set, the new row of the same key as ``_new``, and in ``_beaten`` whether that is the one that counts.

    Either of the two may be missing. ``ages`` decide between them; of rows of the same age the new one counts.
    """
    taken = F.col("_new").getField
    rivals = new.select(F.struct(*map(named, new.columns)).alias("_new"))
    same = functools.reduce(and_, (named(key).eqNullSafe(taken(key)) for key in keys))
    older = F.struct(*map(named, ages)) <= F.struct(*(taken(column).alias(column) for column in ages))
    met = old.withColumn("_old", F.lit(True)).join(rivals, same, "full")
    return met.withColumns(
        {"_beaten": F.col("_old").isNull() | (F.col("_new").isNotNull() & older), "_old": F.coalesce("_old", F.lit(False))}
    )


def in_hours(hours: Sequence[tuple[int, ...]]) -> Column:
    """Whether a row is in one of the hours; selects directories, like ``from_hour``."""
    return F.struct(*EVENT_PARTITIONS).isin([F.struct(*map(F.lit, hour)) for hour in hours])


def _in_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` by name; those that are missing are NULL."""
    present = set(df.columns)
    return df.select(
        *(
            (named(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        )
    )


def upsert_latest(
    spark: SparkSession, source: DataFrame, target: str, spec: UpsertSpec, table_format: str = "parquet"
) -> int | None:
    """Fold the source rows after the stored mark into the table at ``target``; returns the mark used.

    A new row replaces the stored row of the same key. Hours are part of the key, so only the hours that new rows fall
    into are read back and overwritten. Late rows at or below the mark are skipped, unless ``late_seconds`` moves the
    mark back. Rows without an event hour are never stored.

    A lost driver loses nothing: see ``replace_hours``.
    """
    planned = plan_upsert(spark, source, target, spec, table_format)
    try:
        replace_hours(planned.rows, target, table_format, first=planned.mark is None)
    finally:
        planned.done()
    return planned.mark


def settle(spark: SparkSession, target: str) -> None:
    """Deal with what a lost driver left of ``replace_hours``."""
    if exists(spark, f"{target}_staging/_SUCCESS"):
        publish_hours(spark, f"{target}_staging", target)


def is_loaded(spark: SparkSession, target: str) -> bool:
    """Whether there is a table whose first load was finished."""
    return exists(spark, target) and not exists(spark, f"{target}_loading")


def stored_mark(spark: SparkSession, target: str, column: str, table_format: str = "parquet") -> int | None:
    """The greatest ``column`` of the newest stored hour, in which the table's greatest lies; None without rows.

    For Parquet it comes from the footers of that hour's files.
    """
    if not is_loaded(spark, target):
        return None
    if table_format != "parquet":
        newest = newest_hour(spark, target, table_format)
        return None if newest is None else max_mark(newest, column).first()[0]
    folder = next(hour_folders(spark, target), None)
    return None if folder is None else footer_max(spark, folder, column)


# Scans by Spark's newer reader, which can answer a maximum from footers, and lets it do so.
FOOTER_SETTINGS = {
    "spark.sql.sources.useV1SourceList": "",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def footer_scan(spark: SparkSession, folder: str, column: str) -> DataFrame:
    """One row with the greatest ``column`` of the files in ``folder``, as their footers tell it."""
    reader = spark.newSession()
    for key, value in FOOTER_SETTINGS.items():
        reader.conf.set(key, value)
    return max_mark(reader.read.parquet(folder), column)


def footer_max(spark: SparkSession, folder: str, column: str) -> int | None:
    """The greatest ``column`` of the files in ``folder``; NULL without rows.

    Footers have no maximum of a row group that is all NULL or was written without statistics. Such files are scanned.
    """
    try:
        return footer_scan(spark, folder, column).first()[0]
    except (PySparkException, Py4JError) as error:
        if "No min/max found" not in str(error):
            raise
        return max_mark(spark.read.parquet(folder), column).first()[0]


def hours_among(
    spark: SparkSession, target: str, hours: Sequence[tuple[int, ...]], table_format: str = "parquet"
) -> tuple[DataFrame, Sequence[tuple[int, ...]]] | None:
    """The stored rows of the given hours (year to hour), and which of these hours are stored; None if none is.

    Opens no file of another hour. Of a table in another format than Parquet every hour counts as stored.
    """
    if table_format != "parquet":
        return (spark.read.format(table_format).load(target).filter(in_hours(hours)), hours) if hours else None
    there = [hour for hour in hours if _holds_files(spark, f"{target}/{hour_path(hour)}")]
    return (_read_hours(spark, target, [f"{target}/{hour_path(hour)}" for hour in there]), there) if there else None


def _holds_files(spark: SparkSession, folder: str) -> bool:
    return any(name.endswith(".parquet") for name in child_names(spark, folder))


def hour_path(hour: Sequence[int]) -> str:
    return "/".join(f"{level}={value}" for level, value in zip(EVENT_PARTITIONS, hour))


def stored_hour(spark: SparkSession, target: str, table_format: str = "parquet") -> DataFrame | None:
    """The rows of the newest hour, after what a lost driver left of ``replace_hours`` has been dealt with."""
    settle(spark, target)
    return None if exists(spark, f"{target}_loading") else newest_hour(spark, target, table_format)


def replace_hours(df: DataFrame, target: str, table_format: str = "parquet", first: bool = False) -> None:
    """Replace the hours of the table at ``target`` that ``df`` has rows of.

    Replacing Parquet partitions is not atomic. They are therefore written to ``{target}_staging`` and then moved;
    a finished staging table that a lost driver left is published by the next ``stored_hour``. The ``first`` rows of
    a table need no staging: as long as ``{target}_loading`` exists, the table counts as empty and is loaded anew.
    """
    spark, gathered = df.sparkSession, df.hint("rebalance", *EVENT_PARTITIONS)
    if table_format != "parquet":
        _write_hours(gathered, target, table_format, "dynamic")
    elif first:
        make_dir(spark, f"{target}_loading")
        _write_hours(gathered, target, "parquet", "static")
        delete(spark, f"{target}_loading")
    else:
        _write_hours(gathered, f"{target}_staging", "parquet", "static")
        publish_hours(spark, f"{target}_staging", target)


def joint_path(target: str) -> str:
    """Where hours of ``target`` are staged that are published together with those of other tables."""
    return f"{target}_joint"


def stage_jointly(rows: DataFrame, target: str) -> None:
    """Stage hours of one of several Parquet tables whose hours are replaced all or none, by ``publish_together``."""
    _write_hours(rows.hint("rebalance", *EVENT_PARTITIONS), joint_path(target), "parquet", "static")


def publish_together(spark: SparkSession, targets: Sequence[str], marker: str) -> None:
    """Replace the hours staged for all ``targets``. Before the ``marker`` folder is there a lost driver leaves none of them
    replaced; after it ``settle_together`` finishes what one left.
    """
    make_dir(spark, marker)
    settle_together(spark, targets, marker)


def settle_together(spark: SparkSession, targets: Sequence[str], marker: str) -> None:
    """Publish what is staged for ``targets`` if all of it is, else drop it."""
    if exists(spark, marker):
        for target in targets:
            publish_hours(spark, joint_path(target), target)
        delete(spark, marker)
    for target in targets:
        delete(spark, joint_path(target))


def _write_hours(df: DataFrame, path: str, table_format: str, overwrite: str) -> None:
    with set_for_now(df.sparkSession, SHUFFLES_GO):
        (
            df.write.mode("overwrite")
            .format(table_format)
            .option("partitionOverwriteMode", overwrite)
            .partitionBy(*EVENT_PARTITIONS)
            .save(path)
        )


def publish_hours(spark: SparkSession, staging: str, target: str) -> None:
    """Move the staged hours into the target; repeating it moves those that are still there."""
    for folder in list(hour_folders(spark, staging)):
        move(spark, folder, f"{target}{folder.removeprefix(staging)}")
    delete(spark, staging)
