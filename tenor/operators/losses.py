"""Losses (D12, D13) as per-row array expressions plus one aggregation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenor import vocab
from tenor.functions import probs


def nll(logits: str, gold: str):
    """-log softmax(logits)[gold]."""
    return -F.get(probs.log_softmax(logits), F.col(gold))


def cross_entropy(df: DataFrame, logits: str = "student", gold: str = "gold") -> DataFrame:
    """Mean negative log-likelihood, and the class-weighted mean
    sum(w_y * nll) / sum(w_y) with w_y the relative frequency of class y (as the
    original's class weights)."""
    per_class = (df.select(F.col(gold).alias("_y"), nll(logits, gold).alias("_nll"))
                 .groupBy("_y").agg(F.count(F.lit(1)).alias("_n"), F.sum("_nll").alias("_s")))
    # w_y = n_y / N, so sum(w nll) / sum(w) = sum(n_y S_y) / sum(n_y^2)
    return per_class.agg(
        F.sum("_n").alias("n"),
        (F.sum("_s") / F.sum("_n")).alias("ce"),
        (F.sum(F.col("_n") * F.col("_s")) / F.sum(F.col("_n") * F.col("_n"))).alias("ce_weighted"))


def distillation_loss(df: DataFrame, student: str = "student", teacher: str = "teacher", gold: str = "gold",
                      alpha: float | Column = vocab.DISTILL_ALPHA, temperature: float = vocab.DISTILL_TEMPERATURE,
                      by: tuple[str, ...] = ()) -> DataFrame:
    """(1 - alpha) CE + alpha T^2 mean KL(teacher_T || student_T), over all rows or per ``by`` (then with
    their number ``n``); alpha may be an aggregate column, when it differs by group.

    ``kl`` is the divergence taken on log-probabilities (the intended loss);
    ``kl_raw`` is sum q (log q - p), the value the original computes by passing
    probabilities where log-probabilities are expected.
    """
    t = float(temperature)
    lq = probs.log_softmax(teacher, t)
    lp = probs.log_softmax(student, t)
    pairs = F.arrays_zip(lq.alias("lq"), lp.alias("lp"))
    # a class the teacher gives probability 0 adds nothing (0 log 0 = 0); the logs stay finite
    term = lambda z, p: F.when(F.exp(z["lq"]) > 0, F.exp(z["lq"]) * (z["lq"] - p)).otherwise(0.0)
    kl = F.aggregate(pairs, F.lit(0.0), lambda acc, z: acc + term(z, z["lp"]))
    kl_raw = F.aggregate(pairs, F.lit(0.0), lambda acc, z: acc + term(z, F.exp(z["lp"])))
    rows = df.select("*", nll(student, gold).alias("_nll"), kl.alias("_kl"), kl_raw.alias("_klr"))
    a, t2 = alpha if isinstance(alpha, Column) else F.max(F.lit(float(alpha))), F.lit(t * t)
    agg = rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.avg("_nll").alias("ce"), F.avg("_kl").alias("kl"),
                                F.avg("_klr").alias("kl_raw"), a.alias("_a"))
    a = F.col("_a")
    return agg.select(*by, *(["n"] if by else []), "ce", "kl", "kl_raw",
                      ((F.lit(1.0) - a) * F.col("ce") + a * t2 * F.col("kl")).alias("loss"),
                      ((F.lit(1.0) - a) * F.col("ce") + a * t2 * F.col("kl_raw")).alias("loss_raw"))
