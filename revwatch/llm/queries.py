"""Registered queries of the subpackage, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from revwatch.llm import (
    chaining,
    decontaminate,
    lexical,
    neighbours,
    packing,
    quality,
    repair,
    secrets,
    simhash,
    styletree,
    templates,
    urlrules,
    warc,
)
from revwatch.llm.common import table


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.scan_secrets(table(spark, sf_dir, "documents")))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(quality.quality_rules(table(spark, sf_dir, "documents")))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contamination_digest(decontaminate.find_contamination(docs, benchmark))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return styletree.extraction_digest(styletree.extract_text(table(spark, sf_dir, "pages")))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_digest(simhash.near_duplicates(table(spark, sf_dir, "documents")))


def op6_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return templates.drop_templates(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), cached=1_300_000)


def op8_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf_dir, "documents"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlrules.judge_urls(table(spark, sf_dir, "pages")).drop("matched")


def op11_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair_digest(repair.repair_conversations(repair.damaged(table(spark, sf_dir, "conversations"))))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secret_scan,
        op2_quality_rules,
        op3_benchmark_decontamination,
        op4_html_extraction,
        op5_simhash_near_dedup,
        op6_line_templates,
        op7_best_fit_packing,
        op8_warc_archives,
        op9_substring_dedup,
        op10_url_filters,
        op11_nn_descent,
        op12_conversation_repair,
        op13_ranked_search,
    )
}
