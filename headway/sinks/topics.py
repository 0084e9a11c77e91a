"""Publishing messages to a topic, or to files with a topic's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from headway.operators.messages import encode_value


def publish_messages(messages: DataFrame, topic: str, bootstrap_servers: str) -> None:
    """Send each row of a batch as one unkeyed JSON record; needs the Kafka connector on the class path."""
    encode_value(messages).write.format("kafka").options(**_options(topic, bootstrap_servers)).save()


def start_publishing(
    messages: DataFrame, topic: str, bootstrap_servers: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Send the rows of a stream as they come; needs the Kafka connector on the class path."""
    return _start(messages, "kafka", _options(topic, bootstrap_servers), checkpoint, trigger)


def start_recording(messages: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """The same into Parquet files, which ``replay_topic`` and ``recorded_topic`` read."""
    return _start(messages, "parquet", {"path": path}, checkpoint, trigger)


def _options(topic: str, bootstrap_servers: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "topic": topic}


def _start(messages: DataFrame, sink: str, options: dict, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    if not checkpoint:
        raise ValueError("a stream of messages needs a checkpoint, or it sends everything again when it restarts")
    writer = encode_value(messages).writeStream.format(sink).options(**options)
    writer = writer.option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()
