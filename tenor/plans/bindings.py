"""Bindings: give the driver's tables the shapes the original project reads.

Each binding is a lazy DataFrame over the parquet tables in ``sf_dir``; the
same shapes are written in DuckDB SQL in ``tenor.plans.oracle`` so every
operator has an independent oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenor import vocab
from tenor.operators import taxonomy

# FIXED VALUES of the binding: source label -> raw target name (src0..src19).
# src0..src15 follow the 16-name prompt id table; src16 and src17 are unmapped on purpose.
SOURCE_RAW = ["middle_east", "latino", "chinese", "muslim", "bisexual", "mexican", "lgbtq",
              "physical_disability", "mental_disability", "asian", "women", "jewish", "immigrant",
              "native_american", "black", "trans", "arabs", "gay", "african", "hispanic"]

# Scale of the embedding-derived logits.
LOGIT_SCALE = 12.0
# Indicator threshold of the wide (survey) binding.
INDICATOR_THRESHOLD = 0.1
N_INDICATORS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def source_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f"src{i}", raw) for i, raw in enumerate(SOURCE_RAW)],
                                 "source string, raw string")


def tone_of(toxic: Column) -> Column:
    return F.when(toxic == 1, F.lit(vocab.TONES[1])).otherwise(F.lit(vocab.TONES[0]))


# --------------------------------------------------------------------------- B-CORPUS


def corpus_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with tone and raw target: (doc_id, seq, tone, raw, text)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    return (docs.join(labels, "doc_id")
            .join(F.broadcast(source_dim(spark)), "source")
            .select("doc_id", F.lit(0).alias("seq"), tone_of(F.col("toxic")).alias("tone"), "raw", "text"))


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B-CORPUS after the taxonomy: (doc_id, seq, tone, raw, target, text), mapped rows only."""
    return taxonomy.map_taxonomy(corpus_raw(spark, sf_dir))


# --------------------------------------------------------------------------- B-LINES


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents split at newline: (doc_id, seq, tone, raw, target, text); tone and
    target are null for unlabelled documents or unmapped raw names."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    tax = F.broadcast(vocab.taxonomy_df(spark).select("raw", "target"))
    joined = (docs.join(labels, "doc_id", "left")
              .join(F.broadcast(source_dim(spark)), "source")
              .join(tax, "raw", "left"))
    tone = F.when(F.col("toxic").isNull(), F.lit(None).cast("string")).otherwise(tone_of(F.col("toxic")))
    return (joined.select("doc_id", tone.alias("tone"), "raw", "target",
                          F.posexplode(F.split("text", "\n")).alias("seq", "line"))
            .select("doc_id", F.col("seq").cast("int").alias("seq"), "tone", "raw", "target",
                    F.col("line").alias("text")))


def line_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document split at newline, text only: (doc_id, seq, text)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("seq", "line"))
            .select("doc_id", F.col("seq").cast("int").alias("seq"), F.col("line").alias("text")))


def prompt_file_name(tone: Column, raw: Column) -> Column:
    """Synthetic prompt file name ``{tone}_{raw}_1k.txt``."""
    return F.concat(tone, F.lit("_"), raw, F.lit("_1k.txt"))


# --------------------------------------------------------------------------- B-VOTES


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (post, annotator): (post_id, annotator, label, targets, tokens)."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    ann = vocab.ANNOTATION_TARGETS
    names = F.array(*[F.lit(a) for a in ann])
    label = (F.when(F.col("event_type").isin("error", "purchase"), F.lit("hatespeech"))
             .when(F.col("event_type") == "click", F.lit("offensive"))
             .otherwise(F.lit("normal")))
    i1 = F.pmod(F.col("user_id"), F.lit(5)).cast("int")
    i2 = (F.lit(5) + F.pmod(F.floor(F.col("value")), F.lit(4))).cast("int")
    targets = F.array_distinct(F.array(F.get(names, i1), F.get(names, i2)))
    return ev.select(
        F.expr("event_id div 3").alias("post_id"),
        F.pmod(F.col("event_id"), F.lit(3)).cast("int").alias("annotator"),
        label.alias("label"),
        targets.alias("targets"),
        F.array(F.col("event_type"), F.col("user_id").cast("string")).alias("tokens"),
    )


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested per-post form, the shape of the annotated JSON:
    (post_id, annotators ARRAY<STRUCT<label, target ARRAY>>, post_tokens ARRAY)."""
    v = votes(spark, sf_dir)
    agg = v.groupBy("post_id").agg(
        F.array_sort(F.collect_list(F.struct("annotator", "label", "targets", "tokens"))).alias("a"))
    return agg.select(
        "post_id",
        F.transform("a", lambda x: F.struct(x["label"].alias("label"), x["targets"].alias("target"))).alias("annotators"),
        F.flatten(F.transform("a", lambda x: x["tokens"])).alias("post_tokens"),
    )


# --------------------------------------------------------------------------- B-WIDE


def wide_columns() -> dict[str, list[int]]:
    """Survey positions re-based on the binding's 64 columns: positions from 63 on (63 is the score here, the others do not
    exist) go to columns no group uses, the disabilities 67..74 to 0..7 and 63, 65, 66 of ``others`` to 8, 9, 10."""
    free = {63: 8, 65: 9, 66: 10, **{p: p - 67 for p in range(67, 75)}}
    return {grp: [free.get(c, c) for c in cols] for grp, cols in vocab.SURVEY_COLUMNS.items()}


def indicator_name(i: int) -> str:
    return f"ind_{i:02d}"


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, text, hate_speech_score, ind_00 .. ind_63)."""
    emb = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    e = F.col("embedding")
    cols = [F.col("vec_id"),
            F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("text"),
            (F.get(e, 63).cast("double") * F.lit(5.0)).alias("hate_speech_score")]
    cols += [(F.get(e, i).cast("double") > F.lit(INDICATOR_THRESHOLD)).alias(indicator_name(i))
             for i in range(N_INDICATORS)]
    return emb.select(*cols)


# --------------------------------------------------------------------------- B-PROBA / B-LOGITS


def _scaled_slice(start0: int, n: int) -> Column:
    return F.transform(F.slice(F.col("embedding"), start0 + 1, n),
                       lambda x: x.cast("double") * F.lit(LOGIT_SCALE))


def proba(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, router ARRAY<DOUBLE>[11], l0 ARRAY<DOUBLE>[11], l1 ARRAY<DOUBLE>[11], gold INT, label INT)."""
    emb = table(spark, sf_dir, "embeddings")
    n = len(vocab.GROUPS)
    return emb.select(
        "vec_id",
        _scaled_slice(0, n).alias("router"),
        _scaled_slice(11, n).alias("l0"),
        _scaled_slice(22, n).alias("l1"),
        (F.col("label") >= 5).cast("int").alias("gold"),
        "label",
    )


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(vec_id, teacher ARRAY<DOUBLE>[2], student ARRAY<DOUBLE>[2], gold INT)."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", _scaled_slice(33, 2).alias("teacher"), _scaled_slice(35, 2).alias("student"),
                      (F.col("label") >= 5).cast("int").alias("gold"))


# --------------------------------------------------------------------------- B-LOG / B-TESTSET


def metrics_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(epoch INT, mode STRING, metric STRING, value DOUBLE)."""
    ev = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", "value")
    metric = (F.when(F.col("event_type") == "view", F.lit("loss"))
              .when(F.col("event_type") == "click", F.lit("acc"))
              .when(F.col("event_type") == "signup", F.lit("f1")))
    mode = F.when(F.pmod(F.col("user_id"), F.lit(2)) == 0, F.lit("train")).otherwise(F.lit("eval"))
    return (ev.select(F.dayofmonth("ts").alias("epoch"), mode.alias("mode"), metric.alias("metric"), "value")
            .where(F.col("metric").isNotNull())
            .groupBy("epoch", "mode", "metric").agg(F.avg("value").alias("value")))


def testset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label, text) of labelled documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return docs.join(labels, "doc_id").select("doc_id", "label", "text")
