"""A table as complete versions side by side; readers take the newest finished one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from headway.session import SHUFFLES_GO, set_for_now
from headway.storage import child_names, delete, exists, modified_at

RETAIN_SECONDS = 3600


class Versions:
    """Each ``add`` writes one new version below ``path``; it counts once its ``_SUCCESS`` marker exists.

    A version goes ``retain_seconds`` after a newer one took its place, by the store's own clock; choose it not
    shorter than the longest read.
    """

    def __init__(self, spark: SparkSession, path: str, retain_seconds: float = RETAIN_SECONDS):
        self.spark = spark
        self.path = path
        self.retain_seconds = retain_seconds

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def _numbers(self) -> list[int]:
        """Numbers of all versions, oldest first; one listing."""
        names = child_names(self.spark, self.path)
        return sorted(int(name.removeprefix("version=")) for name in names if name.startswith("version="))

    def _newest_finished(self, numbers: list[int]) -> int | None:
        """Only the newest version can be an unfinished one, which the next ``add`` overwrites."""
        return next((n for n in reversed(numbers) if exists(self.spark, f"{self._folder(n)}/_SUCCESS")), None)

    def newest(self) -> DataFrame | None:
        """The newest version; None before the first one."""
        version = self._newest_finished(self._numbers())
        return None if version is None else self.spark.read.parquet(self._folder(version))

    def add(self, df: DataFrame) -> None:
        """Write ``df`` as the next version. ``df`` may read the newest one."""
        numbers = self._numbers()
        last = self._newest_finished(numbers)
        version = 0 if last is None else last + 1
        with set_for_now(df.sparkSession, SHUFFLES_GO):
            df.write.mode("overwrite").parquet(self._folder(version))
        self._forget([*(n for n in numbers if n < version), version])

    def _forget(self, finished: list[int]) -> None:
        """Delete the versions whose successor is older than the retention; looks no further than the first young one."""
        now = modified_at(self.spark, f"{self._folder(finished[-1])}/_SUCCESS")
        for version, successor in zip(finished, finished[1:]):
            if now - modified_at(self.spark, f"{self._folder(successor)}/_SUCCESS") <= self.retain_seconds:
                break
            delete(self.spark, self._folder(version))
