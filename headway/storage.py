"""Small file-system helpers on Hadoop's FileSystem, so that they work on any store Spark reads."""

from __future__ import annotations

import functools

from pyspark.sql import SparkSession


@functools.lru_cache(maxsize=1)
def _path_class(jvm):
    """Looked up once for a JVM: each part of the package's name is a call of its own."""
    return jvm.org.apache.hadoop.fs.Path


def _locate(spark: SparkSession, path: str):
    location = _path_class(spark._jvm)(path)
    return location.getFileSystem(spark._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    fs, location = _locate(spark, path)
    return fs.exists(location)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty when it does not exist."""
    fs, location = _locate(spark, path)
    if not fs.exists(location):
        return []
    return [status.getPath().getName() for status in fs.listStatus(location)]


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Paths of all Parquet files below ``path``, relative to it.

    Lists the folders one by one. A recursive listing would ask for the place and the owner of every single file.
    """
    fs, location = _locate(spark, path)
    if not fs.exists(location):
        return []
    found, folders = [], [("", location)]
    while folders:
        prefix, folder = folders.pop()
        for status in fs.listStatus(folder):
            place = status.getPath()
            name = f"{prefix}{place.getName()}"
            if status.isDirectory():
                folders.append((f"{name}/", place))
            elif name.endswith(".parquet"):
                found.append(name)
    return sorted(found)


def child_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Names directly below ``path`` with the epoch seconds at which each was last written, in one listing."""
    fs, location = _locate(spark, path)
    if not fs.exists(location):
        return {}
    return {status.getPath().getName(): status.getModificationTime() / 1000 for status in fs.listStatus(location)}


def modified_at(spark: SparkSession, path: str) -> float:
    """Epoch seconds at which a file was last written, by the store's clock."""
    fs, location = _locate(spark, path)
    return fs.getFileStatus(location).getModificationTime() / 1000


def delete(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.delete(location, True)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, location = _locate(spark, path)
    fs.mkdirs(location)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Give a file or folder another place in the same store, where there is nothing yet. One step for whoever looks."""
    fs, location = _locate(spark, source)
    _, place = _locate(spark, target)
    fs.mkdirs(place.getParent())
    if fs.exists(place) or not fs.rename(location, place):
        raise OSError(f"could not rename {source} to {target}")


def move(spark: SparkSession, source: str, target: str) -> None:
    """Put a folder in the place of another one of the same store."""
    fs, location = _locate(spark, source)
    _, place = _locate(spark, target)
    fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(location, place):
        raise OSError(f"could not move {source} to {target}")
