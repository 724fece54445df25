"""Each operator of this package applied to its whole table, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ridgeway.llm import (
    audit,
    decontaminate,
    fim,
    language,
    lines,
    pack,
    private,
    quality,
    rules,
    shard,
    simhash,
    sql_twins,
    toxicity,
    urls,
)
from ridgeway.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), width=3, radius=3)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), window=10)


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.shards(read(spark, sf_dir, "documents"), weights=(1.0,) * 16)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack.pack(read(spark, sf_dir, "documents"), capacity=2048)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.7)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judged(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(read(spark, sf_dir, "documents"))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_verdicts(read(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.dedup_lines(docs, min_words=50, counts=("n_lines", "n_deleted"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.private_spans(read(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), threshold=0.5)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(read(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_simhash_dedup": op1_simhash_dedup,
        "op2_decontamination": op2_decontamination,
        "op9_sharding": op9_sharding,
        "op10_packing": op10_packing,
        "op5_quality_classifier": op5_quality_classifier,
        "op6_quality_rules": op6_quality_rules,
        "op3_language_id": op3_language_id,
        "op8_url_filters": op8_url_filters,
        "op7_line_dedup": op7_line_dedup,
        "op4_personal_data": op4_personal_data,
        "op11_toxicity": op11_toxicity,
        "op12_fill_in_middle": op12_fill_in_middle,
        "op13_filter_audit": op13_filter_audit,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontamination": sql_twins.OP2,
        "op7_line_dedup": sql_twins.OP7,
        "op12_fill_in_middle": sql_twins.OP12,
        "op13_filter_audit": sql_twins.OP13,
    }
