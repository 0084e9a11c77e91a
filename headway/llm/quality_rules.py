"""Quality rules: plain counts with fixed limits, then a log-likelihood ratio of hashed n-grams. DataFrame functions only.

Words and word pairs fall into ``BUCKETS`` hash buckets. Two multinomials over the buckets, one of trusted documents and
one of all documents, give each bucket the logarithm of their ratio in millionths. A document's score is the sum over its
n-grams divided by their number; it is kept from ``THRESHOLD`` on. All sums are integers, so verdicts do not depend on
the order of rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.common import BLANK

BUCKETS = 1 << 14
FILTER_WORDS = 1 << 17
SMOOTHING = 1.0
THRESHOLD = -0.1
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
SCALE = 1_000_000


def _pairs(column: str, gap: int) -> Column:
    """Hash of each element with the one ``gap`` further on; the last ``gap`` elements stand for nothing."""
    return F.transform(column, lambda h, i: F.xxhash64(h, F.get(column, i + gap)))


def _first(column: str, lost: int) -> Column:
    return F.slice(column, 1, F.greatest(F.col("n_words") - lost, F.lit(0)))


def hashed_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``words``, ``n_words`` and the hashes ``h1`` of words and ``h2`` of pairs; null texts have no words."""
    cut = F.split(F.coalesce(text, F.lit("")), f"[{BLANK}]+")
    worded = docs.withColumn("words", F.array_remove(cut, ""))
    worded = worded.withColumns({"n_words": F.size("words"), "h1": F.transform("words", lambda w: F.xxhash64(w))})
    return worded.withColumn("h2", _pairs("h1", 1))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def _may_be_among(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``doc_id`` may be in ``ids``, with none that is in it missing.

    The hashed ids set bits in ``FILTER_WORDS`` 64-bit words. That bounds what is broadcast, however many ids there are.
    """
    h = F.xxhash64("doc_id")
    word, bit = h.bitwiseAND(F.lit(FILTER_WORDS - 1)), F.pmod(F.shiftrightunsigned(h, 32), F.lit(64)).cast("int")
    marked = ids.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("mark"))
    filters = marked.groupBy("_word").agg(F.bit_or("mark").alias("_bits"))
    near = docs.withColumn("_word", word).join(F.broadcast(filters), "_word")
    return near.filter(F.getbit("_bits", bit) == 1).drop("_word", "_bits")


def _bucketed(docs: DataFrame, name: str) -> DataFrame:
    both = F.concat(F.transform("h1", _bucket), F.transform(_first("h2", 1), _bucket))
    exploded = hashed_words(docs.select("text")).select(F.explode(both).alias("bucket"))
    return exploded.groupBy("bucket").agg(F.count("*").alias(name))


def bucket_counts(docs: DataFrame, trusted_ids: DataFrame) -> DataFrame:
    """(bucket, raw, trusted): n-grams of all documents, and of those whose ``doc_id`` is in ``trusted_ids``.

    Only texts that may be trusted are shuffled to be joined with the ids, by a join that does not depend on their number.
    """
    texts = docs.select("doc_id", "text")
    ids = trusted_ids.select("doc_id").filter("doc_id IS NOT NULL").distinct()
    # An inner join with distinct ids: Spark would move a semi join below the filter.
    trusted = _may_be_among(texts, ids).join(ids.hint("merge"), "doc_id")
    return _bucketed(texts, "raw").join(_bucketed(trusted, "trusted"), "bucket", "left").fillna(0)


def log_ratios(counts: DataFrame) -> list[int]:
    """Log ratio of each bucket in millionths. ``counts`` has at most one row a bucket, so it may go to the driver.

    Without any trusted n-gram all ratios are zero.
    """
    raw, trusted = [0] * BUCKETS, [0] * BUCKETS
    for row in counts.collect():
        raw[row["bucket"]], trusted[row["bucket"]] = row["raw"], row["trusted"]
    if not sum(trusted):
        return [0] * BUCKETS
    added = SMOOTHING * BUCKETS
    shift = math.log((sum(raw) + added) / (sum(trusted) + added))
    return [round(SCALE * (math.log((t + SMOOTHING) / (r + SMOOTHING)) + shift)) for r, t in zip(raw, trusted)]


def _ratio_sum(column: Column | str, ratios: Column) -> Column:
    return F.aggregate(column, F.lit(0).cast("bigint"), lambda total, h: total + F.get(ratios, _bucket(h)))


def rule_columns(docs: DataFrame, ratios: list[int], threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, counts, base_failed, score, kept) for every row of ``docs``.

    * ``word_chars``: code points in words; ``n_symbols``: characters of ``#*$%&|<>``; ``n_dup_lines``: lines with a word
      equal to an earlier line; ``n_repeat_words``: words in 8-word windows that occur twice or more in the text. Windows
      are compared by 64-bit hashes.
    * ``base_failed``: fewer than 20 words, or more than 30 % of them in such windows.
    * ``score``: mean log ratio of the words and pairs; 0 for a text without words.

    Null, empty and blank texts fail with zero counts; repeated rows are judged alike; no shuffle.
    """
    weights = F.from_json(F.lit(str(ratios)), "array<int>")
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(f"[^{BLANK}]"))
    hashed = hashed_words(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    counted = hashed.select(
        "doc_id",
        F.col("n_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("words", "")).cast("bigint").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
        (_ratio_sum("h1", weights) + _ratio_sum(_first("h2", 1), weights)).alias("ratio_sum"),
        F.greatest(2 * F.col("n_words").cast("bigint") - 1, F.lit(0)).alias("n_grams"),
        _pairs("h2", 2).alias("h4"),
    )
    windows = counted.withColumn("h8", _pairs("h4", 4)).drop("h4").withColumn("h8", _first("h8", WINDOW - 1))
    placed = windows.withColumn("n_dup_lines", (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint")).withColumn(
        # Sorted only where a window occurs twice.
        "sorted",
        F.when(
            F.size(F.array_distinct("h8")) < F.size("h8"),
            F.array_sort(F.transform("h8", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    repeated = F.filter(
        "sorted",
        lambda s, i: (s["h"] == F.get("sorted", i + 1)["h"]) | F.coalesce(s["h"] == F.get("sorted", i - 1)["h"], F.lit(False)),
    )
    placed = placed.drop("h8", "lines").withColumn("at", F.array_sort(F.transform(repeated, lambda s: s["i"])))
    reach = F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(reach, F.lit(0).cast("bigint"), lambda total, n: total + n)
    judged = placed.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("bigint")))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    above = F.col("ratio_sum") >= F.col("n_grams") * round(threshold * SCALE)
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & above).alias("kept"),
        F.when(F.col("n_grams") > 0, F.col("ratio_sum") / F.col("n_grams") / SCALE).otherwise(0.0).alias("score"),
    )


def judge(docs: DataFrame, trusted_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rules and verdict for every document, with the ratios of this corpus."""
    return rule_columns(docs, log_ratios(bucket_counts(docs, trusted_ids)), threshold)
