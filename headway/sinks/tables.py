"""Hour-partitioned silver tables and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from headway.functions import EVENT_PARTITIONS
from headway.session import SHUFFLES_GO, set_for_now
from headway.sinks.versions import Versions
from headway.storage import child_names, delete, exists, files_below, rename


def gather_hours(df: DataFrame) -> DataFrame:
    """Bring the rows of an hour together, so that a write makes few files per hour instead of one per task.

    Adaptive execution, which ``configure`` turns on for batches and streams, splits an hour that is too large for
    one task.
    """
    return df.hint("rebalance", *EVENT_PARTITIONS)


def append_silver(df: DataFrame, path: str, table_format: str = "parquet") -> None:
    """Batch append by event hour."""
    with set_for_now(df.sparkSession, SHUFFLES_GO):
        gather_hours(df).write.mode("append").format(table_format).partitionBy(*EVENT_PARTITIONS).save(path)


def append_batch(df: DataFrame, path: str, batch_id: int, writer_id: str, table_format: str = "parquet") -> None:
    """Append a micro-batch by event hour, once however often it is repeated.

    ``writer_id`` names the stream, whose batches are numbered. A Parquet batch is written whole below ``{path}_batches`` and
    then moved in file by file. What is left there tells a repetition how far the batch had come; the next batch removes it.
    """
    spark, gathered = df.sparkSession, gather_hours(df)
    if table_format != "parquet":
        marked = gathered.write.mode("append").format(table_format).option("txnAppId", writer_id).option("txnVersion", batch_id)
        marked.partitionBy(*EVENT_PARTITIONS).save(path)
        return
    name = f"{writer_id}-{batch_id}"
    staging = f"{path}_batches/{name}"
    if not exists(spark, f"{staging}/_SUCCESS"):
        gathered.write.mode("overwrite").partitionBy(*EVENT_PARTITIONS).parquet(staging)
    for file in files_below(spark, staging):
        folder, _, part = file.rpartition("/")
        rename(spark, f"{staging}/{file}", f"{path}/{folder}/batch-{batch_id}-{part}")
    for old in child_names(spark, f"{path}_batches"):
        if old != name:
            delete(spark, f"{path}_batches/{old}")


def replace_mart(df: DataFrame, path: str, table_format: str = "parquet") -> None:
    """Replace a mart by a fresh result; readers have the old one until the new one is complete."""
    if table_format == "parquet":
        Versions(df.sparkSession, path).add(df)
    else:
        with set_for_now(df.sparkSession, SHUFFLES_GO):
            df.write.mode("overwrite").format(table_format).save(path)


def read_mart(spark: SparkSession, path: str, table_format: str = "parquet") -> DataFrame:
    """The newest complete state of a mart."""
    if table_format != "parquet":
        return spark.read.format(table_format).load(path)
    mart = Versions(spark, path).newest()
    if mart is None:
        raise ValueError(f"nothing was written to {path} yet")
    return mart


def read_table(
    spark: SparkSession, path: str, table_format: str = "parquet", schema: StructType | None = None
) -> DataFrame:
    """Scan a lake table; columns appended later are NULL in older files.

    Without a ``schema``, Parquet has to open every file once just to merge theirs; give one for large tables.
    """
    if schema is not None and table_format == "parquet":
        return spark.read.schema(schema).parquet(path)
    return spark.read.format(table_format).option("mergeSchema", True).load(path)
