"""Corpus-level set operations, dedup and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions.text import strip_text
from tenor.operators import clean, taxonomy


def dedup_keep_first(df: DataFrame, key: str = "text", order: tuple[str, ...] = ("doc_id", "seq")) -> DataFrame:
    """One row per ``key``, the row with the lowest ``order`` kept.

    Partial aggregation collapses copies before the shuffle, so a key held by a third
    of all rows still moves one row per map task. With just (doc_id, seq) the pair is
    packed into one decimal, whose min is a hash aggregate; further columns travel in a
    struct, a sort-based aggregation led by a 64-bit hash of the text.
    """
    others = [c for c in df.columns if c != key and c not in order]
    if not others and order == ("doc_id", "seq"):
        wide = F.lit(1 << 32).cast("decimal(11,0)")
        packed = F.col("doc_id").cast("decimal(20,0)") * wide + F.col("seq").cast("decimal(11,0)")
        low = df.groupBy(key).agg(F.min(packed).alias("_p"))
        low = low.withColumn("_d", F.floor(F.col("_p") / wide).cast("decimal(20,0)"))
        seq = (F.col("_p") - F.col("_d") * wide).cast(df.schema["seq"].dataType)
        return low.select(F.col("_d").cast(df.schema["doc_id"].dataType).alias("doc_id"), seq.alias("seq"), key)
    first = F.min(F.struct(*[F.col(c) for c in order], *[F.col(c) for c in others])).alias("_f")
    return (df.groupBy(F.xxhash64(key).alias("_kh"), key).agg(first)
            .select(*[F.col(f"_f.{c}").alias(c) for c in order], *[F.col(f"_f.{c}").alias(c) for c in others], key))


def distinct_rows(df: DataFrame, cols=("tone", "target", "text")) -> DataFrame:
    """Duplicates removed per (tone, group)."""
    return df.select(*cols).distinct()


def combine_groups(df: DataFrame) -> DataFrame:
    """All groups pooled per tone, deduplicated within each tone."""
    return df.select("tone", "text").distinct()


def concat_all(df: DataFrame) -> DataFrame:
    """Pooled hate rows then pooled neutral rows; a text in both tones appears twice."""
    pooled = combine_groups(df).where(F.col("tone").isin(vocab.TONES[0], vocab.TONES[1]))
    return pooled.select(F.when(F.col("tone") == vocab.TONES[1], 0).otherwise(1).alias("part"), "tone", "text")


def gather_group_ids(df: DataFrame) -> DataFrame:
    """Distinct (target_id, text) over every group file."""
    ids = F.broadcast(vocab.groups_df(df.sparkSession))
    return df.where(F.col("target").isNotNull()).join(ids, "target").select("target_id", "text").distinct()


def data_summary(df: DataFrame) -> DataFrame:
    """D3: hate / neutral counts per group after per-file dedup, every group listed,
    plus an ``overall`` row counted over the pooled, per-tone deduplicated texts."""
    hate, neutral = vocab.TONES[1], vocab.TONES[0]
    dedup = distinct_rows(df)
    per = (dedup.groupBy("target")
           .agg(F.count_if(F.col("tone") == hate).alias("n_hate"),
                F.count_if(F.col("tone") == neutral).alias("n_neutral")))
    # per has one row per group of the 11-group taxonomy: a bounded side to broadcast
    per = (vocab.groups_df(df.sparkSession).join(F.broadcast(per), "target", "left")
           .select("target", F.coalesce("n_hate", F.lit(0)).cast("bigint").alias("n_hate"),
                   F.coalesce("n_neutral", F.lit(0)).cast("bigint").alias("n_neutral")))
    overall = (combine_groups(dedup)
               .agg(F.count_if(F.col("tone") == hate).alias("n_hate"),
                    F.count_if(F.col("tone") == neutral).alias("n_neutral"))
               .select(F.lit("overall").alias("target"), "n_hate", "n_neutral"))
    return per.unionByName(overall)


def distinct_tones_targets(names: DataFrame, name_col: str = "file_name") -> DataFrame:
    """Distinct tones and distinct targets of a folder of prompt files: (kind, value)."""
    parsed = names.select(clean.parse_name(F.col(name_col), "prompt").alias("p"))
    tones = parsed.select(F.lit("tone").alias("kind"), F.col("p.tone").alias("value"))
    targets = parsed.select(F.lit("target").alias("kind"), F.col("p.raw").alias("value"))
    return tones.unionByName(targets).distinct()


def union_sources(annotations: DataFrame, prompts: DataFrame, survey: DataFrame) -> DataFrame:
    """G1: one corpus (origin, tone, target, text) from the three sources.

    annotations: D2 rows (toxic, target, sentence), targets lower-cased through the taxonomy;
    prompts: rows with (tone, raw, text); survey: C3 + B8 rows with (tone, target, text).
    """
    ann = (annotations.select(clean.label_tone(F.col("toxic")).alias("tone"), F.col("target").alias("raw"),
                              F.col("sentence").alias("text")))
    ann = taxonomy.map_taxonomy(ann).select(F.lit("annotations").alias("origin"), "tone", "target", "text")
    pr = taxonomy.map_taxonomy(prompts.select("tone", "raw", "text")).select(
        F.lit("prompts").alias("origin"), "tone", "target", "text")
    sv = survey.select(F.lit("survey").alias("origin"), "tone", "target", "text")
    return ann.unionByName(pr).unionByName(sv)


def build_corpus(annotations: DataFrame, prompts: DataFrame, survey: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole corpus build: (corpus, quarantine).

    Prompt lines pass the prompt cleaning (B2), annotations are D2 rows, survey rows come
    mapped. Raw names go through the taxonomy; texts are stripped, empty ones dropped,
    copies removed per (tone, target) with partial aggregation. ``quarantine`` counts
    the rows without a group by (origin, raw), so nothing disappears unseen."""
    ann = annotations.select(F.lit("annotations").alias("origin"), clean.label_tone(F.col("toxic")).alias("tone"),
                             F.lower("target").alias("raw"), F.col("sentence").alias("text"))
    pr = prompts.select(F.lit("prompts").alias("origin"), "tone", F.lower("raw").alias("raw"),
                        F.explode(clean.clean_prompt("text")).alias("text"))
    named = ann.unionByName(pr)
    quarantine = taxonomy.taxonomy_quarantine(named).groupBy("origin", "raw").agg(F.count(F.lit(1)).alias("n"))
    rows = taxonomy.map_taxonomy(named).select("tone", "target", "text").unionByName(survey.select("tone", "target", "text"))
    corpus = rows.select("tone", "target", strip_text("text").alias("text")).where(F.col("text") != "").distinct()
    return corpus, quarantine
