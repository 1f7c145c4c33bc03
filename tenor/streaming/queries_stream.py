"""Registered streaming / user-function queries (J1, J2); both equal the batch
routed scorer, so they share its oracle."""

from __future__ import annotations

from tenor.plans import bindings, queries_learn
from tenor.plans.contract import ORACLES, r6, register
from tenor.plans.queries_scoring import SCORE_ROUTED_SQL
from tenor.session import scratch_path
from tenor.streaming import stream

_COLS = ("vec_id", "n_groups", "groups", "score", "prediction")


@register("score_stream", SCORE_ROUTED_SQL)
def score_stream_q(spark, sf_dir):
    """B-PROBA rows land as parquet files; a Structured Streaming query scores them."""
    base = scratch_path(spark, "stream")
    src = bindings.proba(spark, sf_dir).select("vec_id", "router", "l0", "l1")
    src.write.mode("overwrite").parquet(f"{base}/in")
    stream.score_stream(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint")
    out = spark.read.schema(stream.SCORED_SCHEMA).parquet(f"{base}/out")
    return out.select("vec_id", "n_groups", "groups", r6("score").alias("score"), "prediction")


@register("score_sentences", ORACLES["score_corpus"])
def score_sentences_q(spark, sf_dir):
    """J1 on sentences: documents land as files and are scored by the stored NB router and experts, with a batch ledger."""
    base = scratch_path(spark, "sentences")
    queries_learn.naive_bayes.nb_fit(queries_learn.nb_train(spark, sf_dir), f"{base}/model")
    queries_learn.nb_docs(spark, sf_dir).write.parquet(f"{base}/in")
    stream.score_sentences(spark, f"{base}/in", f"{base}/out", f"{base}/checkpoint", f"{base}/model")
    out = stream.read_scored_sentences(spark, f"{base}/out")
    return out.select("doc_id", "n_groups", "groups", r6("score").alias("score"), "prediction")


@register("score_udf", SCORE_ROUTED_SQL)
def score_udf_q(spark, sf_dir):
    """Routed mixture with a user-supplied expert function over Arrow batches."""
    p = bindings.proba(spark, sf_dir)
    out = stream.score_udf(p, stream.binary_expert)
    return out.select("vec_id", "n_groups", "groups", r6("score").alias("score"), "prediction")
