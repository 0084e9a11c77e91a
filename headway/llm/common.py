"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from weakref import WeakKeyDictionary

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import fresh_dir
from headway.storage import delete

# White space that separates words, as the body of a character class for Python and Java alike.
BLANK = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Where each stored table lies that is still in use.
_PATHS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def stored(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_dir(df.sparkSession, label)
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _PATHS[table] = path
    return table


def forget(df: DataFrame) -> None:
    """Delete a ``stored`` table that nothing reads any more; other frames are left alone."""
    path = _PATHS.pop(df, None)
    if path:
        delete(df.sparkSession, path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores appended as make it differ from all columns of ``df``."""
    taken = {column.lower() for column in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        free.append(name)
    return free


def row_key(df: DataFrame, seed: int = 0) -> Column:
    """64-bit hash over all columns of a row and over which of them are null; equal rows share it."""
    fields = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        fields += [F.isnull(column), F.to_json(F.struct(column)) if "map<" in kind else column]
    return F.xxhash64(F.lit(seed), *fields)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch with columns replaced or appended; all others stay the Arrow arrays they are."""
    names, arrays = list(batch.schema.names), list(batch.columns)
    for name, array in columns.items():
        if name in names:
            arrays[names.index(name)] = array
        else:
            names.append(name)
            arrays.append(array)
    return pa.RecordBatch.from_arrays(arrays, names=names)


Batches = Iterator[pa.RecordBatch]


def chunks(items: list, size: int) -> Iterable[list]:
    for start in range(0, len(items), size):
        yield items[start : start + size]
