"""A fixed-size bit filter over keys: tells which rows cannot have a partner before anything is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# 64-bit words of a filter. They bound what is broadcast, however many keys there are; with more keys than bits the
# filter lets more and more rows pass, and a join behind it is as it would be without.
WORDS = 1 << 14


def _place(keys: Sequence[str]) -> tuple[Column, Column]:
    """Word and bit of a key; keys are hashed as text, so that both sides may store them in different types."""
    h = F.xxhash64(*(F.coalesce(F.col(key).cast("string"), F.lit("")) for key in keys))
    return h.bitwiseAND(F.lit(WORDS - 1)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(64)).cast("int")


def key_bits(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(word, bits): at most ``WORDS`` rows. NULL keys count as empty text."""
    word, bit = _place(keys)
    marked = df.select(word.alias("word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("mark"))
    return marked.groupBy("word").agg(F.bit_or("mark").alias("bits"))


def may_match(df: DataFrame, bits: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """``df`` with the flag ``name``: false only if the row's key is certainly not among those of ``key_bits``."""
    word, bit = _place(keys)
    at, found = "_word", "_bits"
    while {at, found} & set(df.columns):
        at, found = f"{at}_", f"{found}_"
    known = F.broadcast(bits.select(F.col("word").alias(at), F.col("bits").alias(found)))
    flag = F.coalesce(F.getbit(found, bit) == 1, F.lit(False))
    return df.withColumn(at, word).join(known, at, "left").withColumn(name, flag).drop(at, found)


def only_matching(df: DataFrame, bits: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows whose key may be among those of ``key_bits``."""
    return may_match(df, bits, keys, "_may").filter("_may").drop("_may")
