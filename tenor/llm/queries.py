"""One registered query per corpus operator: whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenor.llm import chat_format, hard_negatives, hash_tree, jaccard_join, maxent_lm, poisson_mix, quality_lines, secret_scan, string_tiling, suffix_dedup, token_counts, turn_repair, url_filter
from tenor.llm.registry import register, table


@register("op1_token_counts")
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.digest(table(spark, sf_dir, "documents"))


@register("op2_suffix_dedup")
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


@register("op3_quality_rules", sql=quality_lines.ORACLE)
def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_lines.digest(table(spark, sf_dir, "documents"))


@register("op4_chat_format", sql=chat_format.ORACLE)
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_format.digest(chat_format.with_special(table(spark, sf_dir, "conversations")))


@register("op5_sharding")
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hash_tree.digest(table(spark, sf_dir, "documents"))


@register("op7_url_filter")
def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.digest(table(spark, sf_dir, "pages"))


@register("op8_lm_scoring")
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maxent_lm.score(table(spark, sf_dir, "documents"))


@register("op9_decontamination")
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op10_mixing", sql=poisson_mix.ORACLE)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return poisson_mix.digest(table(spark, sf_dir, "documents"))


@register("op6_jaccard_join", sql=jaccard_join.ORACLE)
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@register("op12_secret_scan")
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(table(spark, sf_dir, "documents"))


@register("op13_turn_repair")
def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.digest(turn_repair.damage(table(spark, sf_dir, "conversations")))


@register("op11_hard_negatives", sql=hard_negatives.ORACLE)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.digest(table(spark, sf_dir, "embeddings"))
