"""The registered queries of the operators: each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from contestry.llm import (
    block_search,
    decontaminate,
    exact_names,
    licenses,
    line_dedup,
    mixture,
    near_dups,
    preferences,
    private_crf,
    quality_lm,
    suffix_spans,
    token_counts,
    turn_repair,
)
from contestry.llm.oracles import ORACLE_SQL  # noqa: F401


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lm.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicate_report(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination_report(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )


def op4_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_spans.repeat_report(_table(spark, sf_dir, "documents"))


def op5_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preferences.preference_report(_table(spark, sf_dir, "conversations"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_names.duplicate_classes(_table(spark, sf_dir, "documents"))


def op7_token_counts(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_report(_table(spark, sf_dir, "documents"), tokenizer_path)


def op8_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_crf.private_report(_table(spark, sf_dir, "documents"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_report(_table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_report(_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_report(_table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_classifier,
        op2_near_duplicates,
        op3_decontamination,
        op4_repeated_spans,
        op5_preference_pairs,
        op6_exact_dedup,
        op7_token_counts,
        op8_private_data,
        op9_source_mix,
        op10_license_scan,
        op11_line_dedup,
        op12_ranked_search,
        op13_turn_repair,
    )
}
