"""Routed mixture scoring (E2-E4, C6, D7, F1, H6-H8) as DataFrame operators.

The router works on one row at a time (an 11-element probability array), so
routing, weighting and the mixture are array expressions: no shuffle. The
long-form join (C6) and the grouped mixture (D7) are for experts that are
scored elsewhere and arrive keyed by (doc, group).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import probs


def add_routing(df: DataFrame, p: str, out: str = "kept", **kw) -> DataFrame:
    """Add ``out`` = ARRAY<STRUCT<idx, weight>>: retained groups and normalised weights.

    Each stage is its own column (ranked, routed, weighted). Higher-order functions
    are interpreted per row, and a stage referenced several times is not inlined by
    the optimiser when it is its own column, so every row is ranked exactly once.
    """
    return (df.withColumn("_ranked", probs.rank_classes(p))
            .withColumn("_routed", probs.route_ranked("_ranked", **kw))
            .withColumn(out, probs.normalize_weights("_routed"))
            .drop("_ranked", "_routed"))


def softmax_long(df: DataFrame, key: str, logits: str, temperature: float = 1.0) -> DataFrame:
    """(key, idx, p) - class probabilities from a logit array."""
    return (df.select(key, F.posexplode(probs.softmax(logits, temperature)).alias("idx", "p"))
            .withColumn("idx", F.col("idx").cast("int")))


def rank_classes_long(df: DataFrame, key: str, p: str) -> DataFrame:
    """(key, rank, target, p) with classes by p descending, ties by class order."""
    return (df.select(key, F.posexplode(probs.rank_classes(p)).alias("rank", "c"))
            .select(key, F.col("rank").cast("int").alias("rank"),
                    F.get(vocab.groups_array(), F.col("c.idx")).alias("target"), F.col("c.p").alias("p")))


def route_topk(df: DataFrame, key: str, p: str, **kw) -> DataFrame:
    """(key, rank, target, p) of the retained groups (fallback: others, 1.0)."""
    ranked = df.select(key, probs.rank_classes(p).alias("_ranked"))
    return (ranked.select(key, F.posexplode(probs.route_ranked("_ranked", **kw)).alias("rank", "c"))
            .select(key, F.col("rank").cast("int").alias("rank"),
                    F.get(vocab.groups_array(), F.col("c.idx")).alias("target"), F.col("c.p").alias("p")))


def normalize_weights(df: DataFrame, key: str, p: str, **kw) -> DataFrame:
    """(key, target_id, target, weight): retained p over their total."""
    return (add_routing(df, p, "_kept", **kw).select(key, F.explode("_kept").alias("c"))
            .select(key, F.col("c.idx").alias("target_id"),
                    F.get(vocab.groups_array(), F.col("c.idx")).alias("target"), F.col("c.weight").alias("weight")))


def expert_scores_long(df: DataFrame, key: str, l0: str, l1: str) -> DataFrame:
    """H6 long form: (key, target_id, target, p_hate) for every expert."""
    pairs = F.arrays_zip(F.col(l0).alias("a"), F.col(l1).alias("b"))
    return (df.select(key, F.posexplode(pairs).alias("target_id", "z"))
            .select(key, F.col("target_id").cast("int").alias("target_id"),
                    F.get(vocab.groups_array(), F.col("target_id")).alias("target"),
                    probs.p_binary(F.col("z.a"), F.col("z.b")).alias("p_hate")))


def route_expert_join(weights: DataFrame, experts: DataFrame, key: str) -> DataFrame:
    """Retained (key, group, weight) x that group's expert score, on (key, target_id).

    Only retained pairs survive the inner join, so experts that the router did not
    pick contribute nothing; both sides are keyed by the document, so a hot group
    does not concentrate the join.
    """
    return weights.join(experts.select(key, "target_id", "p_hate"), [key, "target_id"])


def mixture_score(joined: DataFrame, key: str, threshold: float = 0.5) -> DataFrame:
    """score = sum of weight x expert per document; prediction = score > threshold."""
    return (joined.groupBy(key).agg(F.sum(F.col("weight") * F.col("p_hate")).alias("score"),
                                    F.count(F.lit(1)).alias("n_groups"))
            .withColumn("prediction", (F.col("score") > F.lit(threshold)).cast("int")))


def score_routed_arrays(kept, l0, l1, threshold: float = 0.5):
    """I8 in array form from a materialised ``kept`` column (see :func:`add_routing`):
    (n_groups, groups, score, prediction) as column expressions."""
    kept = F.col(kept) if isinstance(kept, str) else kept
    l0c, l1c = F.col(l0) if isinstance(l0, str) else l0, F.col(l1) if isinstance(l1, str) else l1
    score = F.aggregate(kept, F.lit(0.0),
                        lambda acc, k: acc + k["weight"] * probs.p_binary(F.get(l0c, k["idx"]), F.get(l1c, k["idx"])))
    return {
        "n_groups": F.size(kept).cast("bigint"),
        "groups": F.array_join(probs.group_names(F.transform(kept, lambda k: k["idx"])), ","),
        "score": score,
        "prediction": (score > F.lit(threshold)).cast("int"),
    }


def score_routed(df: DataFrame, key: str, router_logits: str, l0: str, l1: str, threshold: float = 0.5,
                 **kw) -> DataFrame:
    """I8: router softmax -> retained groups -> normalised weights -> expert mixture."""
    routed = add_routing(df.withColumn("_p", probs.softmax(router_logits)), "_p", "_kept", **kw)
    cols = score_routed_arrays("_kept", l0, l1, threshold)
    return routed.select(key, *[c.alias(n) for n, c in cols.items()])
