"""Registered queries over B-PROBA / B-LOGITS: router, experts, mixture, metrics, losses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import probs
from tenor.operators import losses, metrics, routing, sampling
from tenor.plans import bindings
from tenor.plans.contract import r6, register
from tenor.plans.oracle import GROUP_LIST, hash_sql, with_ctes

# --------------------------------------------------------------------------- I8


def _score_routed_df(spark, sf_dir):
    p = bindings.proba(spark, sf_dir)
    out = routing.score_routed(p, "vec_id", "router", "l0", "l1")
    return out.select("vec_id", "n_groups", "groups", r6("score").alias("score"), "prediction")


SCORE_ROUTED_SQL = with_ctes("""
SELECT vec_id, n_groups, groups, round(score, 6) AS score, CAST(score > 0.5 AS INTEGER) AS prediction
FROM scored""", "scored")


@register("score_routed", SCORE_ROUTED_SQL)
def score_routed(spark, sf_dir):
    """I8 (flagship): router softmax -> top groups -> weights -> expert mixture -> prediction."""
    return _score_routed_df(spark, sf_dir)


def _with_p(spark, sf_dir):
    return bindings.proba(spark, sf_dir).withColumn("p", probs.softmax("router"))


# --------------------------------------------------------------------------- E2, F1, E3, E4, H6-H8


@register("softmax", with_ctes("SELECT vec_id, idx, round(p, 6) AS p FROM router_p", "router_p"))
def softmax_q(spark, sf_dir):
    """Class probabilities of the router logits, long form."""
    out = routing.softmax_long(bindings.proba(spark, sf_dir), "vec_id", "router")
    return out.select("vec_id", "idx", r6("p").alias("p"))


@register("rank_classes", with_ctes(
    f"SELECT vec_id, rnk AS class_rank, {GROUP_LIST}[idx + 1] AS target, round(p, 6) AS p FROM router_ranked",
    "router_ranked"))
def rank_classes_q(spark, sf_dir):
    """every class ranked by p descending, ties in group order."""
    out = routing.rank_classes_long(_with_p(spark, sf_dir), "vec_id", "p")
    return out.select("vec_id", F.col("rank").alias("class_rank"), "target", r6("p").alias("p"))


@register("route_topk", with_ctes(
    f"SELECT vec_id, rnk AS class_rank, {GROUP_LIST}[idx + 1] AS target, round(p, 6) AS p FROM routed", "routed"))
def route_topk_q(spark, sf_dir):
    """Retained groups (at most 3, until cumulative 0.5; fallback below 0.2)."""
    out = routing.route_topk(_with_p(spark, sf_dir), "vec_id", "p")
    return out.select("vec_id", F.col("rank").alias("class_rank"), "target", r6("p").alias("p"))


@register("normalize_weights", with_ctes(
    f"SELECT vec_id, {GROUP_LIST}[idx + 1] AS target, round(weight, 6) AS weight FROM weighted", "weighted"))
def normalize_weights_q(spark, sf_dir):
    """Retained probabilities normalised to sum 1."""
    out = routing.normalize_weights(_with_p(spark, sf_dir), "vec_id", "p")
    return out.select("vec_id", "target", r6("weight").alias("weight"))


@register("binary_probability", with_ctes(
    f"SELECT vec_id, {GROUP_LIST}[idx + 1] AS target, round(1.0 / (1.0 + exp(l0 - l1)), 6) AS p_hate "
    "FROM proba_long", "proba_long"))
def binary_probability_q(spark, sf_dir):
    """H6: P(hate) of every group expert from its two logits."""
    out = routing.expert_scores_long(bindings.proba(spark, sf_dir), "vec_id", "l0", "l1")
    return out.select("vec_id", "target", r6("p_hate").alias("p_hate"))


@register("argmax_class", with_ctes(f"""
SELECT vec_id, idx AS argmax_idx, {GROUP_LIST}[idx + 1] AS argmax_target FROM (
  SELECT vec_id, idx, row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, idx) AS rn FROM proba_long)
WHERE rn = 1""", "proba_long"))
def argmax_class_q(spark, sf_dir):
    """H7: index of the largest router logit (first on ties)."""
    p = bindings.proba(spark, sf_dir)
    idx = probs.argmax("router")
    return p.select("vec_id", idx.alias("argmax_idx"), F.get(vocab.groups_array(), idx).alias("argmax_target"))


@register("zip_classes", with_ctes(
    f"SELECT vec_id, {GROUP_LIST}[idx + 1] AS target, round(p, 6) AS p FROM router_p", "router_p"))
def zip_classes_q(spark, sf_dir):
    """H8: group -> probability map, exploded."""
    p = _with_p(spark, sf_dir)
    return (p.select("vec_id", F.explode(probs.zip_classes("p")).alias("target", "p"))
            .select("vec_id", "target", r6("p").alias("p")))


# --------------------------------------------------------------------------- C6, D7, C7


def _joined(spark, sf_dir):
    base = _with_p(spark, sf_dir)
    weights = routing.normalize_weights(base, "vec_id", "p")
    experts = routing.expert_scores_long(base, "vec_id", "l0", "l1")
    return routing.route_expert_join(weights, experts, "vec_id")


@register("route_expert_join", with_ctes(
    f"SELECT vec_id, {GROUP_LIST}[idx + 1] AS target, round(weight, 6) AS weight, round(p_hate, 6) AS p_hate "
    "FROM weighted", "weighted"))
def route_expert_join_q(spark, sf_dir):
    """Retained groups joined to their expert's score on (doc, group)."""
    j = _joined(spark, sf_dir)
    return j.select("vec_id", "target", r6("weight").alias("weight"), r6("p_hate").alias("p_hate"))


@register("mixture_score", with_ctes(
    "SELECT vec_id, n_groups, round(score, 6) AS score, CAST(score > 0.5 AS INTEGER) AS prediction FROM scored",
    "scored"))
def mixture_score_q(spark, sf_dir):
    """Weighted sum of expert scores per document, prediction at 0.5."""
    m = routing.mixture_score(_joined(spark, sf_dir), "vec_id")
    return m.select("vec_id", "n_groups", r6("score").alias("score"), "prediction")


_ALIGNED_SQL = {"aligned": """
    SELECT s.vec_id, p.gold, CAST(s.score > 0.5 AS INTEGER) AS prediction
    FROM scored s JOIN (SELECT vec_id, CAST(label >= 5 AS INTEGER) AS gold FROM embeddings) p
      ON s.vec_id = p.vec_id"""}


def _aligned(spark, sf_dir):
    scored = _score_routed_df(spark, sf_dir).select("vec_id", "prediction")
    gold = bindings.proba(spark, sf_dir).select("vec_id", "gold")
    return metrics.align_labels(scored, gold, "vec_id")


@register("align_labels", with_ctes("SELECT vec_id, gold, prediction FROM aligned", "scored", extra=_ALIGNED_SQL))
def align_labels_q(spark, sf_dir):
    """Predictions next to gold labels by key."""
    return _aligned(spark, sf_dir).select("vec_id", "gold", "prediction")


# --------------------------------------------------------------------------- D8-D11


def class_table_sql(src: str, gold: str, pred: str, by: str | None = None) -> str:
    b = f"{by}, " if by else ""
    return f"""
    SELECT {b}c, CAST(sum(s) AS BIGINT) AS support, CAST(sum(q) AS BIGINT) AS predicted,
           CAST(sum(t) AS BIGINT) AS tp,
           CASE WHEN sum(q) = 0 THEN 0.0 ELSE sum(t) / sum(q) END AS precision,
           CASE WHEN sum(s) = 0 THEN 0.0 ELSE sum(t) / sum(s) END AS recall,
           CASE WHEN sum(s) + sum(q) = 0 THEN 0.0 ELSE 2 * sum(t) / (sum(s) + sum(q)) END AS f1
    FROM (SELECT {b}{gold} AS c, 1 AS s, 0 AS q, CAST({gold} = {pred} AS INTEGER) AS t FROM {src}
          UNION ALL SELECT {b}{pred} AS c, 0 AS s, 1 AS q, 0 AS t FROM {src})
    GROUP BY {b}c"""


_BINARY_EXTRA = dict(_ALIGNED_SQL, ct=class_table_sql("aligned", "gold", "prediction"))


@register("binary_metrics", with_ctes("""
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 6) AS accuracy,
       round(coalesce(max(CASE WHEN c = 1 THEN precision END), 0.0), 6) AS precision,
       round(coalesce(max(CASE WHEN c = 1 THEN recall END), 0.0), 6) AS recall,
       round(coalesce(max(CASE WHEN c = 1 THEN f1 END), 0.0), 6) AS f1
FROM ct""", "scored", extra=_BINARY_EXTRA))
def binary_metrics_q(spark, sf_dir):
    """Accuracy and F1 of the hate class for the routed predictions."""
    m = metrics.binary_metrics(_aligned(spark, sf_dir))
    return m.select("n", *[r6(c).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


@register("weighted_metrics", with_ctes("""
SELECT CAST(sum(support) AS BIGINT) AS n, round(sum(tp) / sum(support), 6) AS accuracy,
       round(sum(support * precision) / sum(support), 6) AS precision,
       round(sum(support * recall) / sum(support), 6) AS recall,
       round(sum(support * f1) / sum(support), 6) AS f1
FROM ct""", "scored", extra=_BINARY_EXTRA))
def weighted_metrics_q(spark, sf_dir):
    """Accuracy and support-weighted precision / recall / F1."""
    m = metrics.weighted_metrics(_aligned(spark, sf_dir))
    return m.select("n", *[r6(c).alias(c) for c in ["accuracy", "precision", "recall", "f1"]])


_MULTI_EXTRA = {
    "mc": f"""SELECT vec_id, label AS gold, argmax_idx AS prediction FROM (
        SELECT vec_id, label, idx AS argmax_idx,
               row_number() OVER (PARTITION BY vec_id ORDER BY logit DESC, idx) AS rn FROM proba_long) WHERE rn = 1""",
}


def _multiclass(spark, sf_dir):
    p = bindings.proba(spark, sf_dir)
    return p.select("vec_id", F.col("label").alias("gold"), probs.argmax("router").alias("prediction"))


@register("macro_f1", with_ctes("""
SELECT CAST(count(*) AS BIGINT) AS n_classes, CAST(sum(support) AS BIGINT) AS n,
       round(sum(tp) / sum(support), 6) AS accuracy, round(avg(f1), 6) AS macro_f1
FROM ct""", "proba_long", extra=dict(_MULTI_EXTRA, ct=class_table_sql("mc", "gold", "prediction"))))
def macro_f1_q(spark, sf_dir):
    """Macro F1 of the router's arg-max class against the embedding label."""
    m = metrics.macro_f1(_multiclass(spark, sf_dir))
    return m.select("n_classes", "n", r6("accuracy").alias("accuracy"), r6("macro_f1").alias("macro_f1"))


# Three epochs of predictions: the arg-max class of the binding's three logit arrays; mode by the hash split, batches of 50 per mode.
_BATCH_EXTRA = {
    "modes": f"""
    SELECT *, CAST((row_number() OVER (PARTITION BY mode ORDER BY {hash_sql('vec_id', vocab.BATCH_SEED)}, vec_id) - 1) // 50 AS BIGINT) AS batch_id
    FROM (SELECT vec_id, label AS gold, CASE WHEN {hash_sql('vec_id')} < {int(vocab.TEST_FRACTION * (1 << 32))} THEN 'eval' ELSE 'train' END AS mode
          FROM embeddings)""",
    "answers": """
    SELECT vec_id, epoch, arg_max(idx, (z, -idx)) AS prediction FROM (
      SELECT vec_id, idx, unnest([1, 2, 3]) AS epoch, unnest([logit, l0, l1]) AS z FROM proba_long) GROUP BY vec_id, epoch""",
    "mcb": """
    SELECT a.epoch, m.mode, m.batch_id, m.gold, a.prediction, a.epoch || ':' || m.mode || ':' || m.batch_id AS k
    FROM answers a JOIN modes m ON a.vec_id = m.vec_id""",
    "ct": class_table_sql("mcb", "gold", "prediction", by="k"),
    "per": """
    SELECT any_value(split_part(k, ':', 1)) AS epoch, any_value(split_part(k, ':', 2)) AS mode, sum(tp) / sum(support) AS accuracy, avg(f1) AS macro_f1
    FROM ct GROUP BY k"""}


@register("batch_mean_metrics", with_ctes("""
SELECT CAST(epoch AS INTEGER) AS epoch, mode, CAST(count(*) AS BIGINT) AS n_batches, round(avg(accuracy), 6) AS mean_accuracy,
       round(avg(macro_f1), 6) AS mean_macro_f1
FROM per GROUP BY epoch, mode""", "proba_long", extra=_BATCH_EXTRA))
def batch_mean_metrics_q(spark, sf_dir):
    """Accuracy and macro F1 of shuffled batches of 50, averaged by (epoch, mode)."""
    p = sampling.train_test_split(bindings.proba(spark, sf_dir), key="vec_id")
    p = p.withColumn("mode", F.when(F.col("split") == "test", "eval").otherwise("train"))
    ranked = sampling.exact_rank(p, ["mode"], "vec_id", vocab.BATCH_SEED).withColumn("batch_id", F.floor(F.col("rank") / 50).cast("bigint"))
    epochs = F.explode(F.array(*[F.struct(F.lit(e).alias("epoch"), probs.argmax(c).alias("prediction"))
                                 for e, c in enumerate(("router", "l0", "l1"), 1)]))
    rows = ranked.select("mode", "batch_id", F.col("label").alias("gold"), epochs.alias("e")).select("mode", "batch_id", "gold", "e.*")
    m = metrics.batch_mean_metrics(rows)
    return m.select("epoch", "mode", "n_batches", r6("mean_accuracy").alias("mean_accuracy"), r6("mean_macro_f1").alias("mean_macro_f1"))


# --------------------------------------------------------------------------- D12, D13

_LOSS_ROWS = {"lr": f"""
    SELECT gold, student[1] AS s0, student[2] AS s1, teacher[1] AS t0, teacher[2] AS t1,
           greatest(student[1], student[2]) AS sm, greatest(teacher[1], teacher[2]) AS tm
    FROM logits""",
              "nl": f"""
    SELECT *, -((CASE WHEN gold = 1 THEN s1 ELSE s0 END - sm) - ln(exp(s0 - sm) + exp(s1 - sm))) AS nll,
           exp((t0 - tm) / {vocab.DISTILL_TEMPERATURE}) AS qe0, exp((t1 - tm) / {vocab.DISTILL_TEMPERATURE}) AS qe1,
           exp((s0 - sm) / {vocab.DISTILL_TEMPERATURE}) AS pe0, exp((s1 - sm) / {vocab.DISTILL_TEMPERATURE}) AS pe1
    FROM lr""",
              "kq": """
    SELECT nll, qe0 / (qe0 + qe1) AS q0, qe1 / (qe0 + qe1) AS q1, pe0 / (pe0 + pe1) AS p0, pe1 / (pe0 + pe1) AS p1
    FROM nl"""}


@register("cross_entropy", with_ctes("""
SELECT CAST(sum(n) AS BIGINT) AS n, round(sum(s) / sum(n), 6) AS ce, round(sum(n * s) / sum(n * n), 6) AS ce_weighted
FROM (SELECT gold, count(*) AS n, sum(nll) AS s FROM nl GROUP BY gold)""", "logits", extra=_LOSS_ROWS))
def cross_entropy_q(spark, sf_dir):
    """Mean and class-weighted cross-entropy of the student logits."""
    m = losses.cross_entropy(bindings.logits(spark, sf_dir))
    return m.select("n", r6("ce").alias("ce"), r6("ce_weighted").alias("ce_weighted"))


_A, _T2 = vocab.DISTILL_ALPHA, vocab.DISTILL_TEMPERATURE ** 2


@register("distillation_loss", with_ctes(f"""
SELECT round(ce, 6) AS ce, round(kl, 6) AS kl, round(kl_raw, 6) AS kl_raw,
       round((1 - {_A}) * ce + {_A} * {_T2} * kl, 6) AS loss, round((1 - {_A}) * ce + {_A} * {_T2} * kl_raw, 6) AS loss_raw
FROM (SELECT avg(nll) AS ce, avg(q0 * (ln(q0) - ln(p0)) + q1 * (ln(q1) - ln(p1))) AS kl,
             avg(q0 * (ln(q0) - p0) + q1 * (ln(q1) - p1)) AS kl_raw FROM kq)""", "logits", extra=_LOSS_ROWS))
def distillation_loss_q(spark, sf_dir):
    """Distillation loss at alpha 0.25, T 2 (log form and the original's raw form)."""
    m = losses.distillation_loss(bindings.logits(spark, sf_dir))
    return m.select(*[r6(c).alias(c) for c in ["ce", "kl", "kl_raw", "loss", "loss_raw"]])


# --------------------------------------------------------------------------- D14


@register("log_series", with_ctes("""
SELECT epoch,
       round(max(CASE WHEN mode = 'train' AND metric = 'loss' THEN value END), 6) AS train_loss,
       round(max(CASE WHEN mode = 'train' AND metric = 'acc' THEN value END), 6) AS train_acc,
       round(max(CASE WHEN mode = 'train' AND metric = 'f1' THEN value END), 6) AS train_f1,
       round(max(CASE WHEN mode = 'eval' AND metric = 'loss' THEN value END), 6) AS eval_loss,
       round(max(CASE WHEN mode = 'eval' AND metric = 'acc' THEN value END), 6) AS eval_acc,
       round(max(CASE WHEN mode = 'eval' AND metric = 'f1' THEN value END), 6) AS eval_f1
FROM mlog GROUP BY epoch""", "mlog"))
def log_series_q(spark, sf_dir):
    """The metrics log pivoted into six series (train/eval x loss/acc/f1) by epoch."""
    s = metrics.log_series(bindings.metrics_log(spark, sf_dir))
    return s.select("epoch", *[r6(c).alias(c) for c in s.columns if c != "epoch"])
