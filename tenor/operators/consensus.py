"""Annotation consensus (D1, D2) over the per-post nested form.

A post arrives as one row (one object of the annotated JSON), so both
operators are narrow: array expressions per row, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions.text import flatten_targets, join_tokens


def flatten_posts(posts: DataFrame) -> DataFrame:
    """(post_id, annotators, post_tokens) -> (post_id, labels, targets, sentence)."""
    return posts.select(
        "post_id",
        F.transform("annotators", lambda a: a["label"]).alias("labels"),
        flatten_targets(F.transform("annotators", lambda a: a["target"])).alias("targets"),
        join_tokens("post_tokens").alias("sentence"),
    )


def consensus_label(flat: DataFrame, toxic_labels=tuple(vocab.TOXIC_LABELS),
                    min_votes: int = vocab.TOXIC_MIN_VOTES) -> DataFrame:
    """toxic = at least ``min_votes`` annotators gave a toxic label (every annotator votes)."""
    toxic_set = F.array(*[F.lit(x) for x in toxic_labels])
    votes = F.size(F.filter("labels", lambda lab: F.array_contains(toxic_set, lab)))
    return flat.select(
        "post_id",
        F.size("labels").alias("n_annotators"),
        votes.alias("toxic_votes"),
        (votes >= F.lit(min_votes)).cast("int").alias("toxic"),
        "targets", "sentence")


def consensus_targets(flat: DataFrame, toxic_labels=tuple(vocab.TOXIC_LABELS),
                      min_votes: int = vocab.TOXIC_MIN_VOTES) -> DataFrame:
    """One row per surviving target: votes counted over the flattened target list
    (repeats count), at least 2 for a toxic post and 1 otherwise; names outside the
    18-name vocabulary are ignored; posts without a surviving target vanish."""
    labelled = consensus_label(flat, toxic_labels, min_votes)
    known = F.array(*[F.lit(t) for t in vocab.ANNOTATION_TARGETS])
    need = F.when(F.col("toxic") == 1, F.lit(2)).otherwise(F.lit(1))
    counted = F.transform(
        F.filter(F.array_distinct("targets"), lambda t: F.array_contains(known, t)),
        lambda t: F.struct(t.alias("target"), F.size(F.filter("targets", lambda y: y == t)).alias("votes")))
    kept = F.filter(counted, lambda s: s["votes"] >= need)
    return (labelled.select("post_id", "toxic", "sentence", F.explode(kept).alias("k"))
            .select("post_id", "toxic", F.col("k.target").alias("target"),
                    F.col("k.votes").alias("votes"), "sentence"))
