"""The staged corpus job: quality rules, near duplicates, benchmark decontamination,
mixing, sharding. Every stage reads what its predecessor wrote.

A stage is ``f(spark, docs, sf_dir) -> DataFrame``; all but the last return the
columns of ``documents``. ``run`` applies them in order, each result written
to the shared folder and read back. An empty table passes through every
stage; null texts fail the quality rules and go there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tenor.llm import hash_tree, jaccard_join, poisson_mix, quality_lines, string_tiling
from tenor.llm.blocks import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality rules keep, without the lines these remove."""
    return quality_lines.clean(docs).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every group of linked rows (5-word shingles, similarity 0.8)."""
    return jaccard_join.keep_one(docs, k=5, percent=80).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return string_tiling.decontaminate_rows(docs, items).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources replicated to their target weights, globally shuffled."""
    return poisson_mix.mix(docs).select(*docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and its slot there."""
    return hash_tree.shard_documents(docs)


STAGES = [("quality_rules", quality), ("jaccard_join", near_duplicates), ("decontamination", decontamination),
          ("mixing", mixing), ("sharding", sharding)]
#: Near-duplicate components, tiling and checksums have no SQL form on whole tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
