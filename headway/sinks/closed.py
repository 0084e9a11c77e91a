"""Hours of a silver table that have come to an end, rewritten into few files.

A stream commits once a minute, which leaves some sixty small files in each hour. A closed hour is written anew beside the
table, below ``{table}_closed``, and appears there by one rename, together with the names of the files it replaces. Readers
leave out just those files, so that each sees every row once, whenever it looks, rows that come late for a closed hour
included. The replaced files go after a retention.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from headway.functions import EVENT_PARTITIONS, hour_of
from headway.operators.incremental import hour_folders, hour_path
from headway.sinks.tables import read_table
from headway.storage import child_names, child_times, delete, exists, make_dir, rename

LEAST_FILES = 4
RETAIN_SECONDS = 3600
Hour = tuple[int, ...]


def closed_root(path: str) -> str:
    return f"{path}_closed"


def _hours(spark: SparkSession, path: str) -> dict[Hour, list[str]]:
    """The files of the table itself, by hour."""
    found = {}
    for folder in hour_folders(spark, path):
        hour = tuple(int(part.split("=")[1]) for part in folder.removeprefix(f"{path}/").split("/"))
        found[hour] = sorted(f"{folder}/{name}" for name in child_names(spark, folder) if name.endswith(".parquet"))
    return found


def _replaced(spark: SparkSession, path: str, hour: Hour) -> set[str]:
    """Files of the table that the closed hour has the rows of; none if the hour is not closed."""
    names = child_names(spark, f"{closed_root(path)}/{hour_path(hour)}/_replaced")
    return {f"{path}/{hour_path(hour)}/{name}" for name in names}


def close_hours(
    spark: SparkSession, path: str, before: int, retain_seconds: float = RETAIN_SECONDS, least_files: int = LEAST_FILES
) -> list[Hour]:
    """Rewrite the hours that ended by ``before`` (epoch seconds) and have ``least_files`` files or more; returns them.

    An hour is closed once; rows that come for it afterwards stay in files of their own. Replaced files are deleted by the
    first call ``retain_seconds`` after their hour was closed: choose that longer than the longest read. A call that was
    lost has changed nothing that readers see, and is made up for by the next one.
    """
    closed = []
    for hour, files in _hours(spark, path).items():
        place, staging = f"{closed_root(path)}/{hour_path(hour)}", f"{path}_closing/{hour_path(hour)}"
        if hour >= hour_of(before):
            continue
        if exists(spark, place):
            if time.time() - child_times(spark, place)["_SUCCESS"] > retain_seconds:
                for file in _replaced(spark, path, hour).intersection(files):
                    delete(spark, file)
        elif len(files) >= least_files:
            rows = spark.read.option("mergeSchema", True).parquet(*files)
            rows.hint("rebalance").write.mode("overwrite").parquet(staging)
            for file in files:
                make_dir(spark, f"{staging}/_replaced/{file.rsplit('/', 1)[1]}")
            rename(spark, staging, place)
            closed.append(hour)
    delete(spark, f"{path}_closing")
    return closed


def read_silver(spark: SparkSession, path: str, table_format: str = "parquet", schema: StructType | None = None) -> DataFrame:
    """A silver table with its closed hours.

    The hours that have files of their own are settled first. One that is closed only afterwards is still read from the
    table, where its files stay for the retention, and left out of the closed ones.
    """
    if table_format != "parquet" or next(hour_folders(spark, closed_root(path)), None) is None:
        return read_table(spark, path, table_format, schema)
    known = {hour: (files, _replaced(spark, path, hour)) for hour, files in _hours(spark, path).items()}
    unclosed = [F.struct(*map(F.lit, hour)) for hour, (_, replaced) in known.items() if not replaced]
    closed = read_table(spark, closed_root(path), table_format, schema)
    if unclosed:
        closed = closed.filter(~F.struct(*EVENT_PARTITIONS).isin(unclosed))
    files = [file for own, replaced in known.values() for file in own if file not in replaced]
    if not files:
        return closed
    reader = spark.read.option("basePath", path)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", True)
    return closed.unionByName(reader.parquet(*files), allowMissingColumns=True)
