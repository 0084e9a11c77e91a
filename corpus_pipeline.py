"""A corpus pipeline of five operators, each applied to all its predecessor kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.llm import bpe, mixing, pii, simhash, toxicity
from headway.llm.common import forget, stored, table, unused
from headway.llm.queries import TARGETS, VOCABULARY

Stage = tuple[str, object]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model learned from the labels of these documents.

    Null and empty texts score as the model's bias says; equal texts stay or go together; without labels of both classes
    nothing but their prior is learned; an empty table stays empty. All columns pass through.
    """
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id.

    Texts without a word are one group; rows without an id come last in theirs; of rows equal in every column one stays; an
    empty table stays empty. All columns pass through, whatever their names.
    """
    return simhash.keep_one(docs, length=3, distance=2)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind in brackets and ``n_chars`` counted anew.

    Null texts stay null; empty texts, repeated rows and all other columns stay as they are; an empty table stays empty.
    """
    return pii.redact_pii(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents so that the sources have their target shares, in a global random order.

    A null source is one of those without a target; null and empty texts have no size but are copied like any others; rows
    with one id have one number of copies each; an empty table stays empty. All columns pass through.
    """
    return mixing.mix(docs, TARGETS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns but the text, ``n_tokens`` and the ``token_ids`` of each whole text.

    Null and empty texts have no ids; repeated rows are each encoded; an empty table stays empty. Where a column has one of the
    two names already, the new one gets an underscore.
    """
    ids, count = unused(docs, "token_ids", "n_tokens")
    encoded = bpe.encode_texts(docs, public_tokenizers.path(VOCABULARY), ids=ids)
    return encoded.withColumn(count, F.size(ids)).drop("text")


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", near_duplicate_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("encoding", encoding_stage),
]

# The near-duplicate, classifier and tokenizer stages have no SQL form; tests compare with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each is written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        forget(before)
    return STAGES[-1][1](spark, docs, sf_dir)
