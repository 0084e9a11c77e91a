"""Topic scans: Kafka, and a file replay with the same columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.schemas import TOPIC_RECORD

# Offsets may have expired when a job resumes, so their loss must not stop it.
_TOLERANT = {"failOnDataLoss": "false"}


def stream_options(topic: str, servers: str, **extra: str) -> dict[str, str]:
    """A stream follows what arrives from now on. ``minPartitions`` splits a hot topic partition over several tasks,
    ``maxOffsetsPerTrigger`` bounds a micro-batch."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "latest"} | _TOLERANT | extra


def batch_options(topic: str, servers: str, **extra: str) -> dict[str, str]:
    """A batch reads all that the topic still holds."""
    return stream_options(topic, servers, startingOffsets="earliest") | extra


def stream_topic(spark: SparkSession, topic: str, servers: str, **extra: str) -> DataFrame:
    """Follow a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**stream_options(topic, servers, **extra)).load()


def batch_topic(spark: SparkSession, topic: str, servers: str, **extra: str) -> DataFrame:
    """Read a topic as it is; needs the Kafka connector on the class path."""
    return spark.read.format("kafka").options(**batch_options(topic, servers, **extra)).load()


def recorded_topic(spark: SparkSession, path: str) -> DataFrame:
    """Recorded topic files (Parquet with the Kafka source's columns; missing ones read as NULL)."""
    return spark.read.schema(TOPIC_RECORD).parquet(path)


def replay_topic(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Recorded topic files as a stream."""
    options = {"maxFilesPerTrigger": max_files_per_trigger} if max_files_per_trigger else {}
    return spark.readStream.schema(TOPIC_RECORD).options(**options).parquet(path)
