"""Registered source/sink queries (A1-A10): each writes its binding in the
original file layout to a fresh folder under the shared checkpoint folder and
returns what the reader gives back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenor.operators import consensus, routing
from tenor.plans import bindings
from tenor.plans.contract import ORACLES, r6, register
from tenor.plans.oracle import strip_sql, with_ctes
from tenor.plans.queries_corpus import _POST_SQL
from tenor.plans.queries_scoring import SCORE_ROUTED_SQL
from tenor.session import scratch_path
from tenor.sources import files


_PROMPTS_SQL = f"""
SELECT tone, raw AS target, {strip_sql('f')} AS text FROM (
  SELECT tone, raw, unnest(list_filter(list_transform(string_split(text, '\\n'), lambda x: replace(x, '-', '')),
                                       lambda x: x <> '')) AS f
  FROM lines WHERE tone IS NOT NULL)"""


@register("read_prompts", with_ctes(_PROMPTS_SQL, "lines"))
def read_prompts_q(spark, sf_dir):
    """A1: prompt files named ``{tone}_{raw}_1k.txt`` -> cleaned (tone, target, text)."""
    path = scratch_path(spark, "prompts")
    ln = bindings.lines(spark, sf_dir).where(F.col("tone").isNotNull())
    files.write_prompts(ln.select(bindings.prompt_file_name(F.col("tone"), F.col("raw")).alias("file_name"), "text"),
                        path)
    return files.read_prompts(spark, path)


@register("read_delimited_records", f"""
SELECT {strip_sql('r')} AS text FROM (SELECT unnest(string_split(text, chr(10) || '-')) AS r FROM documents)
WHERE {strip_sql('r')} <> ''""")
def read_delimited_records_q(spark, sf_dir):
    """A2: documents written one after another, each closed by a newline-dash separator,
    read back as newline-dash delimited records."""
    path = scratch_path(spark, "delimited")
    docs = bindings.table(spark, sf_dir, "documents")
    docs.select(F.concat("text", F.lit("\n-")).alias("value")).write.mode("overwrite").text(path)
    return files.read_delimited(spark, path, "\n-")


@register("read_annotations", with_ctes("SELECT post_id, labels, targets, sentence FROM posts", "votes",
                                        extra=_POST_SQL))
def read_annotations_q(spark, sf_dir):
    """A3: annotated posts as keyed JSON, read back and flattened."""
    path = scratch_path(spark, "annotations")
    files.write_annotations(bindings.posts(spark, sf_dir), path)
    flat = consensus.flatten_posts(files.read_annotations(spark, path))
    return flat.select("post_id", F.array_join("labels", ",").alias("labels"),
                       F.array_join("targets", ",").alias("targets"), "sentence")


@register("read_annotations_object", ORACLES["read_annotations"])
def read_annotations_object_q(spark, sf_dir):
    """A3, the original layout: large objects keyed by post id, read in splits."""
    path = scratch_path(spark, "annotations-object")
    files.write_annotations_object(bindings.posts(spark, sf_dir), path)
    flat = consensus.flatten_posts(files.read_annotations(spark, path, layout="object"))
    return flat.select("post_id", F.array_join("labels", ",").alias("labels"),
                       F.array_join("targets", ",").alias("targets"), "sentence")


@register("read_labeled_csv", with_ctes("SELECT tone, raw AS target, text FROM corpus_raw", "corpus_raw"))
def read_labeled_csv_q(spark, sf_dir):
    """A4: ``tone,target,text`` CSV with header (quotes, commas, newlines in text)."""
    path = scratch_path(spark, "labeled-csv")
    c = bindings.corpus_raw(spark, sf_dir).select("tone", F.col("raw").alias("target"), "text")
    files.write_csv(c, path, header=True)
    return files.read_labeled_csv(spark, path)


@register("read_corpus_csv", with_ctes("SELECT tone, target, text FROM corpus", "corpus"))
def read_corpus_csv_q(spark, sf_dir):
    """A4, header-less layout: one file set per (tone, group), both read from the file name."""
    path = scratch_path(spark, "corpus-csv")
    files.write_corpus_csv(bindings.corpus(spark, sf_dir), path)
    return files.read_corpus_csv(spark, path)


@register("read_indicator_table", with_ctes(
    "SELECT * REPLACE (round(hate_speech_score, 6) AS hate_speech_score) FROM wide", "wide"))
def read_indicator_table_q(spark, sf_dir):
    """A5: the wide survey table through parquet."""
    path = scratch_path(spark, "survey")
    bindings.wide(spark, sf_dir).write.mode("overwrite").parquet(path)
    t = files.read_indicator_table(spark, path)
    return t.withColumn("hate_speech_score", r6("hate_speech_score"))


@register("read_testset", with_ctes("SELECT doc_id, label, text FROM testset", "testset"))
def read_testset_q(spark, sf_dir):
    """Keyed (label, text) test CSV without header."""
    path = scratch_path(spark, "testset")
    files.write_csv(bindings.testset(spark, sf_dir), path, header=False)
    return files.read_testset(spark, path)


@register("write_corpus", with_ctes("SELECT doc_id, tone, target, text FROM corpus", "corpus"))
def write_corpus_q(spark, sf_dir):
    """Corpus partitioned by (tone, group) and read back."""
    path = scratch_path(spark, "corpus")
    files.write_corpus(bindings.corpus(spark, sf_dir).select("doc_id", "tone", "target", "text"), path)
    return files.read_corpus(spark, path).select("doc_id", "tone", "target", "text")


_PROBS_SQL = SCORE_ROUTED_SQL.replace("SELECT vec_id, n_groups, groups, round(score, 6) AS score",
                                     "SELECT vec_id, round(score, 6) AS score")


@register("write_probabilities", _PROBS_SQL)
def write_probabilities_q(spark, sf_dir):
    """Routed scores written as JSON lines and read back."""
    path = scratch_path(spark, "probabilities")
    out = routing.score_routed(bindings.proba(spark, sf_dir), "vec_id", "router", "l0", "l1")
    files.write_probabilities(out, path)
    back = files.read_probabilities(spark, path)
    return back.select("vec_id", r6("score").alias("score"), "prediction")


@register("write_probabilities_document", _PROBS_SQL)
def write_probabilities_document_q(spark, sf_dir):
    """A8, original layout: routed scores as one JSON array from many tasks, read back."""
    path = scratch_path(spark, "probabilities-document")
    out = routing.score_routed(bindings.proba(spark, sf_dir), "vec_id", "router", "l0", "l1")
    files.write_probabilities_document(out.select("vec_id", "score", "prediction"), path)
    back = files.read_probabilities_document(spark, path)
    return back.select("vec_id", r6("score").alias("score"), "prediction")


@register("metrics_log", with_ctes("SELECT epoch, mode, metric, round(value, 6) AS value FROM mlog", "mlog"))
def metrics_log_q(spark, sf_dir):
    """The epoch/mode/metric/value log through a header-less CSV."""
    path = scratch_path(spark, "metrics-log")
    files.write_metrics_log(bindings.metrics_log(spark, sf_dir), path)
    back = files.read_metrics_log(spark, path)
    return back.select("epoch", "mode", "metric", r6("value").alias("value"))


@register("read_scoring_input", with_ctes(f"""
SELECT 'txt' AS fmt, {strip_sql('l')} AS text FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents)
UNION ALL SELECT 'csv' AS fmt, text FROM documents"""))
def read_scoring_input_q(spark, sf_dir):
    """A10: sentences read by extension: ``.txt`` stripped lines, ``.csv`` first column."""
    base = scratch_path(spark, "scoring-input")
    c = bindings.table(spark, sf_dir, "documents").select("text")
    c.write.mode("overwrite").text(f"{base}/input.txt")
    files.write_csv(c, f"{base}/input.csv", header=False)
    txt = files.read_scoring_input(spark, f"{base}/input.txt").withColumn("fmt", F.lit("txt"))
    csv = files.read_scoring_input(spark, f"{base}/input.csv").withColumn("fmt", F.lit("csv"))
    return txt.unionByName(csv).select("fmt", "text")
