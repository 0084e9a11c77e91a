"""Newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _sortable(kind: DataType) -> bool:
    """Whether values of a type have an order; maps and variants have none, nor has anything that holds one."""
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    parts = [field.dataType for field in kind] if isinstance(kind, StructType) else []
    return not isinstance(kind, (MapType, VariantType)) and all(map(_sortable, parts))


def named(name: str) -> Column:
    """A top-level column of any name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def age_columns(schema: StructType, keys: Sequence[str], order: Sequence[str], ties: Sequence[str] | None = None) -> list[str]:
    """What decides which of two rows of a key is newer: ``order``, then ``ties``.

    By default all other columns that have an order break ties, so that only identical rows can tie.
    """
    if ties is None:
        ties = [field.name for field in schema if field.name not in {*keys, *order} and _sortable(field.dataType)]
    return [*order, *ties]


def latest_by(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Keep the row with the greatest ``order`` values for each key; NULL keys form one group.

    ``ties`` names the columns that decide between equal ``order`` values. By default all remaining columns do;
    pass a shorter list when it is already decisive and wide rows should stay prunable. Filtering on rank 1 lets
    Spark keep one row per key in each input task before the shuffle, so a hot key costs one row per task.
    """
    newest_first = [named(name).desc_nulls_last() for name in age_columns(df.schema, keys, order, ties)]
    per_key = Window.partitionBy(*map(named, keys)).orderBy(*newest_first)
    return df.withColumn("row_num", F.row_number().over(per_key)).filter("row_num = 1").drop("row_num")
