"""Static schedule data: per-mode Parquet directories, and published CSV tables as dated snapshots."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.storage import child_names, child_times, exists

# Folder number of each mode in the published archive, and the tables that are kept.
MODE_FOLDERS = {"4": "bus"}
SNAPSHOT_TABLES = ("stops", "routes", "trips", "stop_times")
SNAPSHOT_PARTITIONS = ("transport_mode", "valid_from")
MAX_RECORDS_PER_FILE = 100_000

# The non-text columns of the published tables. Everything else, ids above all, stays text.
NUMERIC_COLUMNS = {
    "stop_lat": "double",
    "stop_lon": "double",
    "location_type": "int",
    "wheelchair_boarding": "int",
    "route_type": "int",
    "direction_id": "int",
    "wheelchair_accessible": "int",
    "stop_sequence": "int",
    "pickup_type": "int",
    "drop_off_type": "int",
    "shape_dist_traveled": "double",
}


# Endings of the names of text columns, whatever type a directory stores them in.
_TEXT_ENDINGS = ("_id", "_name", "_headsign", "_time")


def declared_types(df: DataFrame) -> DataFrame:
    """Published columns in their declared types: numbers where they are ones (else NULL), ids and names as text."""
    typed = {}
    for name, kind in df.dtypes:
        if name in NUMERIC_COLUMNS and kind != NUMERIC_COLUMNS[name]:
            typed[name] = F.col(name).try_cast(NUMERIC_COLUMNS[name])
        elif name not in NUMERIC_COLUMNS and name.endswith(_TEXT_ENDINGS) and kind != "string":
            typed[name] = F.col(name).cast("string")
    return df.withColumns(typed) if typed else df


def read_static(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Union Parquet directories by name; a column that some directories lack is NULL for their rows."""
    return union_static([spark.read.parquet(path) for path in paths], columns)


def union_static(tables: Sequence[DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """UNION ALL by name, in declared types. With ``columns`` each table is first narrowed to those of them it has."""
    if columns:
        missing = [c for c in columns if not any(c in t.columns for t in tables)]
        if missing:
            raise ValueError(f"no table has {missing}")
        tables = [t.select(*(c for c in columns if c in t.columns)) for t in tables]
    tables = [declared_types(t) for t in tables]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    return union.select(*columns) if columns else union


def read_gtfs_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read one published CSV table. Column names come from the header, so their order may vary."""
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    numeric = {c: F.col(c).try_cast(kind) for c, kind in NUMERIC_COLUMNS.items() if c in raw.columns}
    return raw.withColumns(numeric) if numeric else raw


def tag_snapshot(df: DataFrame, mode: str, valid_from: str, ingested_at: dt.datetime | None = None) -> DataFrame:
    """Add the mode, the validity date and one ingestion time for the whole table.

    ``ingested_at`` should be timezone-aware; by default it is the current time.
    """
    clock = ingested_at or dt.datetime.now(dt.timezone.utc)
    return df.withColumns(
        {
            "transport_mode": F.lit(mode),
            "valid_from": F.lit(dt.date.fromisoformat(valid_from)),
            "ingested_at": F.lit(clock),
        }
    )


def append_snapshot(snapshot: DataFrame, path: str, table_format: str = "parquet") -> None:
    """Append a tagged snapshot, partitioned by mode and date, in files of bounded length."""
    (
        snapshot.write.mode("append")
        .format(table_format)
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .option("mergeSchema", True)
        .partitionBy(*SNAPSHOT_PARTITIONS)
        .save(path)
    )


def snapshot_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of all snapshots below a Parquet table, by mode and then date."""
    mode, day = (f"{name}=" for name in SNAPSHOT_PARTITIONS)
    below = lambda folder, prefix: sorted(n for n in child_names(spark, folder) if n.startswith(prefix))
    return [f"{path}/{m}/{d}" for m in below(path, mode) for d in below(f"{path}/{m}", day)]


def schema_files(spark: SparkSession, path: str) -> list[str]:
    """The newest file of each snapshot. One load writes a snapshot's files alike, so these know all its columns."""
    newest = []
    for folder in snapshot_folders(spark, path):
        times = {name: t for name, t in child_times(spark, folder).items() if name.endswith(".parquet")}
        if times:
            newest.append(f"{folder}/{max(times, key=lambda name: (times[name], name))}")
    return newest


def read_snapshots(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """All versions of a dimension; columns added by later snapshots are NULL in earlier ones.

    The schema of a Parquet table is merged from one footer of each snapshot, not from all footers of all history.
    """
    if table_format != "parquet":
        return spark.read.format(table_format).option("mergeSchema", True).load(path)
    files = schema_files(spark, path)
    if not files:  # not partitioned by snapshot
        return spark.read.option("mergeSchema", True).parquet(path)
    schema = spark.read.option("basePath", path).option("mergeSchema", True).parquet(*files).schema
    return spark.read.schema(schema).parquet(path)


def read_newest_snapshots(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """The newest dated snapshot of each mode below a Parquet table, in declared types; opens no other file."""
    newest = list({folder.rsplit("/", 1)[0]: folder for folder in snapshot_folders(spark, path)}.values())
    if not newest:
        raise ValueError(f"no snapshot below {path}")
    return read_static(spark, newest, columns)


def load_published_tables(
    spark: SparkSession,
    source: str,
    target: str,
    valid_from: str,
    modes: Mapping[str, str] = MODE_FOLDERS,
    tables: Sequence[str] = SNAPSHOT_TABLES,
    ingested_at: dt.datetime | None = None,
    table_format: str = "parquet",
) -> list[str]:
    """Append every extracted ``{source}/{folder}/{table}.txt`` to ``{target}/{table}``; absent files are skipped.

    Returns the paths that were loaded.
    """
    loaded = []
    for folder, mode in modes.items():
        for table in tables:
            path = f"{source}/{folder}/{table}.txt"
            if exists(spark, path):
                snapshot = tag_snapshot(read_gtfs_csv(spark, path), mode, valid_from, ingested_at)
                append_snapshot(snapshot, f"{target}/{table}", table_format)
                loaded.append(path)
    return loaded
