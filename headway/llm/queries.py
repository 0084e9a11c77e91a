"""Registered queries of this subpackage. Each takes ``(spark, sf_dir)`` and reads whole tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from headway.llm import (
    bpe,
    filter_audit,
    mixing,
    pii,
    prefix_trie,
    quality_rules,
    secrets,
    simhash,
    topk,
    toxicity,
    url_filters,
    warc,
    weak_labels,
)
from headway.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = "byte_bpe_50k.json"
# Shares of the mixed corpus; the sources not listed share the rest by size.
TARGETS = {"src0": 0.10, "src1": 0.10, "src2": 0.10, "src3": 0.05}


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.digest_columns(pii.find_pii(docs))


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge(table(spark, sf_dir, "pages"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.archived(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest_columns(table(spark, sf_dir, "documents"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest_columns(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))


def op7_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_labels.judge(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").filter("quality = 1")
    return quality_rules.judge(table(spark, sf_dir, "documents"), trusted)


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest_columns(table(spark, sf_dir, "documents"), TARGETS)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest_columns(secrets.find_secrets(table(spark, sf_dir, "documents")))


def on_workers(run: Query) -> Query:
    """Let Python workers import this package from where the driver has it, as they do when it is installed."""
    root = str(Path(__file__).resolve().parents[2])

    @functools.wraps(run)
    def ready(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.get("PYTHONPATH", "")
        if root not in paths.split(":"):
            spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{root}".strip(":")
        return run(spark, sf_dir)

    return ready


def llm_queries() -> dict[str, Query]:
    operators = (
        op1_pii,
        op2_url_filters,
        op3_warc,
        op4_simhash,
        op5_topk,
        op6_bpe,
        op7_weak_labels,
        op8_quality_rules,
        op9_mixing,
        op10_toxicity,
        op11_prefix_trie,
        op12_filter_audit,
        op13_secrets,
    )
    return {run.__name__: on_workers(run) for run in operators}


def mixing_sql() -> str:
    """Counterpart of ``op9_mixing``: cumulative probabilities as rows, compared with each document's hashed number."""
    shares = " ".join(f"WHEN '{name}' THEN {share}" for name, share in TARGETS.items())
    names = ", ".join(f"'{name}'" for name in TARGETS)
    rest = max(0.0, 1 - sum(TARGETS.values()))
    return f"""
WITH named AS (
  SELECT doc_id, source, text, CASE WHEN source IN ({names}) THEN source ELSE '' END AS name,
         CAST('0x' || substr(md5(concat_ws('|', '{mixing.SEED}', coalesce(CAST(doc_id AS VARCHAR), ''))), 1, {mixing.DIGITS})
              AS BIGINT) AS number
  FROM documents),
sized AS (SELECT name, CAST(sum(length(text)) AS DOUBLE) AS size FROM named GROUP BY name),
whole AS (SELECT sum(size) AS total FROM sized),
means AS (SELECT name, (CASE name {shares} ELSE {rest} END) * total / size AS mean FROM sized, whole),
terms AS (
  SELECT name, k, exp(k * ln(mean) - mean - lgamma(k + 1.0)) AS p
  FROM means, (SELECT unnest(generate_series(0, 120)) AS k)),
reached AS (
  SELECT name, k, floor(sum(p) OVER (PARTITION BY name ORDER BY k) * {mixing.RANGE}.0) AS threshold FROM terms),
counted AS (
  SELECT n.doc_id, n.source, n.text, count(*) AS copies
  FROM named n JOIN reached r ON n.name = r.name AND r.threshold <= n.number
  GROUP BY n.doc_id, n.source, n.text),
copied AS (SELECT doc_id, source, text, unnest(generate_series(1, copies)) AS copy FROM counted)
SELECT doc_id, source, CAST(copy AS INTEGER) AS copy,
       md5(concat_ws('|', '{mixing.SEED + 1}', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(copy AS VARCHAR))) AS mix_key,
       md5(coalesce(text, '')) AS text_md5
FROM copied"""


def llm_oracles() -> dict[str, str]:
    return {
        "op2_url_filters": url_filters.judge_sql(),
        "op9_mixing": mixing_sql(),
        "op11_prefix_trie": prefix_trie.trie_sql(),
        "op12_filter_audit": filter_audit.audit_sql(),
        "op13_secrets": secrets.digest_sql(),
    }
