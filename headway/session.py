"""Session settings the jobs rely on, and the shared folder for intermediate tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

RUNTIME_SETTINGS = {
    # Hour partitions and schedule arithmetic are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: broadcast by measured size, split of skewed join and rebalance partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.streaming.stateless.enabled": "true",
    # Group on all keys. Reusing a shuffle on some of them would put a hot trip into one task, and would do away
    # with the per-task reduction before the shuffle.
    "spark.sql.requireAllClusterKeysForDistribution": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def set_for_now(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings that go back to what they were."""
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# For a write: its shuffles go from the executors' disks when it ends. Else they stay until the driver happens to collect its
# garbage, those of all earlier steps of a job among them. No later action shares the shuffles of a write.
SHUFFLES_GO = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create (or get) a session; ``settings`` are extra Spark options with ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in RUNTIME_SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return configure(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder, which is then kept for the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="headway-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
